"""Boosted quantiles: trees fitted to the pinball loss, several levels side by side.

A round fits one tree per level to the sign of the residuals, weighted by the level. Each leaf then takes the exact quantile of
its training residuals, as `quantiles.exact_quantiles` finds it for all leaves of all levels in one pass. What the driver holds
is the trees and one number per leaf.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourweave.operators.boosting import PATIENCE, WRITE_EVERY, Stopper, ensemble, leaves, one_tree
from hourweave.operators.quantiles import exact_quantiles
from hourweave.session import materialise


def pinball(level: float, residual: Column) -> Column:
    return F.greatest(F.lit(level) * residual, F.lit(level - 1.0) * residual)


def _sum_of_leaves(places: Column, table: Column) -> Column:
    return F.aggregate(F.transform(places, lambda leaf, tree: table[tree][leaf]), F.lit(0.0), lambda a, x: a + x)


class BoostedQuantiles:
    """Per level: where it starts, its trees and, per tree, the value of each leaf."""

    def __init__(self, spark: SparkSession, levels: Sequence[float], starts: Sequence[float], step: float) -> None:
        self.spark, self.levels, self.starts, self.step = spark, list(levels), list(starts), step
        self.trees: list[list] = [[] for _ in levels]
        self.values: list[list[list[float]]] = [[] for _ in levels]

    def rounds(self) -> int:
        return len(self.trees[0])

    def added(self, data: DataFrame, base: Column, name: str, since: int = 0) -> DataFrame:
        """`data` with `name`: the array `base` plus what the trees from round `since` on add."""
        out, sums = data, []
        for k in range(len(self.levels)):
            total = base[k]
            if self.rounds() > since:
                own = ensemble(self.spark, self.trees[k][since:], [1.0] * (self.rounds() - since), "label").setPredictionCol(f"_p{k}")
                out = leaves(own, out, f"_at{k}").drop(f"_p{k}")
                # a number per leaf of these trees, as a constant
                table = F.from_json(F.lit(json.dumps(self.values[k][since:])), "array<array<double>>")
                total = total + F.lit(self.step) * _sum_of_leaves(F.col(f"_at{k}"), table)
            sums.append(total)
        return out.withColumn(name, F.array(*sums)).drop(*[f"_at{k}" for k in range(len(self.levels))])

    def transform(self, data: DataFrame, names: Sequence[str]) -> DataFrame:
        """`data` (with `features`) and one column per level. Levels are fitted apart, so that they may cross."""
        scored = self.added(data, F.array(*[F.lit(x) for x in self.starts]), "_levels")
        return scored.withColumns({name: F.col("_levels")[k] for k, name in enumerate(names)}).drop("_levels")


def fit_pinball(
    data: DataFrame, estimator: GBTRegressor, levels: Sequence[float] = (0.1, 0.5, 0.9), patience: int = PATIENCE, write_every: int = WRITE_EVERY,
    gain: float = 0.0, workers: int = 4,
) -> BoostedQuantiles:
    """Pinball boosting of (features, label, split) up to the best round, by the loss of all levels on the validation rows.

    Without validation rows all rounds are fitted. Rows with a null label take no part; there must be training rows.
    """
    spark, label, every = data.sparkSession, estimator.getLabelCol(), range(len(levels))
    rows = data.where(F.col("split").isin("train", "val") & F.col(label).isNotNull()).select(
        "features", F.col(label).cast("double").alias("label"), (F.col("split") == "val").alias("held"))
    rows = materialise(rows, "pinball")
    # one row per level
    found = {r.prob: r.value for r in exact_quantiles(rows.where(~F.col("held")), ["label"], levels).collect()}
    if not found:
        raise ValueError("no training rows")
    model = BoostedQuantiles(spark, levels, [found[float(p)] for p in levels], estimator.getStepSize())
    rows, since = rows.withColumn("score", F.array(*[F.lit(x) for x in model.starts])), 0
    watched, stop = not rows.where("held").isEmpty(), Stopper(patience, gain)
    residuals = [F.col("label") - F.col("now")[k] for k in every]

    def scored(df: DataFrame) -> DataFrame:
        return model.added(df, F.col("score"), "now", since)

    with ThreadPoolExecutor(workers) as pool:
        for number in range(estimator.getMaxIter()):
            train = scored(rows.where(~F.col("held")))
            pushes = train.select("features", *[F.when(residuals[k] > 0, F.lit(levels[k])).otherwise(levels[k] - 1.0).alias(f"g{k}") for k in every])

            def fit(k: int, pushes: DataFrame = pushes, number: int = number):
                return one_tree(estimator, estimator.getSeed() + number * len(levels) + k, f"g{k}").fit(pushes)._java_obj.trees()[0]

            grown = list(pool.map(inheritable_thread_target(spark)(fit), every))
            _append(model, grown, _leaf_values(spark, train, grown, residuals, levels))
            if watched:
                loss = sum((pinball(levels[k], residuals[k]) for k in every), F.lit(0.0))
                if stop.over(scored(rows.where("held")).agg(F.avg(loss)).first()[0]):
                    break
            if model.rounds() - since >= write_every:
                rows = materialise(scored(rows).select("features", "label", "held", F.col("now").alias("score")), "pinball")
                since = model.rounds()
    if watched:
        for k in every:
            model.trees[k], model.values[k] = model.trees[k][: stop.best], model.values[k][: stop.best]
    return model


def _append(model: BoostedQuantiles, grown: Sequence, values: Sequence[list[float]]) -> None:
    for k, (tree, own) in enumerate(zip(grown, values)):
        model.trees[k].append(tree)
        model.values[k].append(own)


def _leaf_values(spark: SparkSession, train: DataFrame, grown: Sequence, residuals: Sequence[Column], levels: Sequence[float]) -> list[list[float]]:
    """Per level the value of each leaf of its new tree: the exact quantile of the training residuals there."""
    placed = train
    for k, tree in enumerate(grown):
        placed = leaves(ensemble(spark, [tree], [1.0], "label").setPredictionCol(f"_p{k}"), placed, f"_at{k}").drop(f"_p{k}")
    entries = [F.struct(F.lit(k).alias("level"), F.col(f"_at{k}")[0].alias("leaf"), residuals[k].alias("residual")) for k in range(len(grown))]
    cuts = exact_quantiles(placed.select(F.inline(F.array(*entries))), ["residual"], levels, ["level", "leaf"])
    own_level = F.element_at(F.array(*[F.lit(float(p)) for p in levels]), F.col("level") + 1)
    out: list[list[float]] = [[] for _ in grown]
    # one row per leaf
    for row in cuts.where(F.col("prob") == own_level).orderBy("level", "leaf").collect():
        mine = out[row.level]
        mine += [0.0] * (row.leaf - len(mine)) + [row.value]
    return out
