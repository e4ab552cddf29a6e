"""Distributed models on MLlib and the interval estimates built on them.

Rows come as features plus `split`; fits see training rows, early stopping sees validation
rows, and no row is sampled away.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException, IllegalArgumentException, PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourweave.functions.scalar import DAM, RTM, SPREAD, attach_row, regime
from hourweave.functions.timeutil import HOUR, KEY
from hourweave.operators.boosting import PATIENCE, fit_boosted, leaves
from hourweave.operators.ensemble import sweep_metrics
from hourweave.operators.extra_trees import ExtraTrees
from hourweave.operators.pinball import fit_pinball
from hourweave.operators.prep import train_rows
from hourweave.operators.quantiles import exact_quantiles, quantile_columns
from hourweave.operators.windows import lag_features
from hourweave.session import materialise

Z95 = 1.959964


def gbt(
    label: str = SPREAD, rounds: int = 1000, depth: int = 6, step: float = 0.05, min_leaf: int = 20, share: float = 0.8, seed: int = 42,
) -> GBTRegressor:
    """Boosted trees; `fit` stops them by the validation rows."""
    return GBTRegressor(
        labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=step, minInstancesPerNode=min_leaf,
        subsamplingRate=0.8, featureSubsetStrategy=str(share), seed=seed,
    )


def random_forest(label: str = SPREAD, trees: int = 200, depth: int = 20, min_leaf: int = 50, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt", seed=seed,
    )


def extra_trees(label: str = SPREAD, trees: int = 200, depth: int = 20, min_split: int = 100, min_leaf: int = 50, seed: int = 42) -> ExtraTrees:
    return ExtraTrees(label, trees, depth, min_split, min_leaf, "sqrt", seed)


def linear_models(n_rows: int, label: str = SPREAD) -> dict[str, LinearRegression]:
    """Ridge, lasso, elastic net and Huber regression with penalties of 1 on the weights as they are.

    The ridge penalty is meant against the sum of squares of `n_rows` training rows, MLlib's against their mean.
    """
    base = {"labelCol": label, "featuresCol": "features", "standardization": False}
    return {
        "ridge": LinearRegression(regParam=1.0 / max(1, n_rows), elasticNetParam=0.0, **base),
        "lasso": LinearRegression(regParam=1.0, elasticNetParam=1.0, **base),
        "elastic_net": LinearRegression(regParam=1.0, elasticNetParam=0.5, **base),
        "huber": LinearRegression(loss="huber", epsilon=1.35, maxIter=100, **base),
    }


def regime_classifier(kind: str = "forest", trees: int = 100, depth: int = 10, seed: int = 42) -> Estimator:
    base = {"labelCol": "regime", "featuresCol": "features"}
    if kind == "forest":
        return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **base)
    return LogisticRegression(family="multinomial", maxIter=100, **base)


def fit(data: DataFrame, features: Sequence[str], estimator: Estimator, patience: int = PATIENCE, gain: float = 0.0) -> PipelineModel:
    """Fit on the training rows; boosting stops `patience` rounds after the last one that bettered the validation loss by the share `gain`."""
    assemble = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    if isinstance(estimator, GBTRegressor):
        return PipelineModel(stages=[assemble, fit_boosted(assemble.transform(data), estimator, patience, gain=gain)])
    return Pipeline(stages=[assemble, estimator]).fit(train_rows(data))


def predict(model: PipelineModel, data: DataFrame, name: str, label: str = SPREAD, keys: Sequence[str] = (HOUR, KEY)) -> DataFrame:
    """Rows (keys, split, model, y, prediction)."""
    return model.transform(data).select(
        *keys, "split", F.lit(name).alias("model"), F.col(label).alias("y"), F.col("prediction")
    )


def sweep(
    data: DataFrame, features: Sequence[str], specs: dict[str, Estimator], label: str = SPREAD, workers: int = 4, patience: int = PATIENCE,
) -> tuple[DataFrame, dict[str, str]]:
    """Fit every model and stack their predictions, with the reasons of those that cannot be fitted.

    Fits are submitted by `workers` threads, each model in a scheduler pool of its own, over one stored table. Wrong
    parameters or columns fail at once; a fit whose job fails is tried once more, then counts as failed too.
    """
    stored = materialise(data, "sweep")

    def attempt(item: tuple[str, Estimator]) -> PipelineModel | str:
        name, estimator = item
        data.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        for last in (False, True):
            try:
                return fit(stored, features, estimator, patience)
            except (IllegalArgumentException, AnalysisException) as error:
                return str(error).splitlines()[0]
            except (PySparkException, Py4JJavaError) as error:
                if last:
                    return str(error).splitlines()[0]

    with ThreadPoolExecutor(workers) as pool:
        fitted = dict(zip(specs, pool.map(inheritable_thread_target(data.sparkSession)(attempt), specs.items())))
    failures = {name: model for name, model in fitted.items() if isinstance(model, str)}
    frames = [predict(model, stored, name, label) for name, model in fitted.items() if name not in failures]
    if not frames:
        raise RuntimeError(f"no model could be fitted: {failures}")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out, failures


def sweep_specs(n_rows: int, label: str = SPREAD, rounds: int = 1000, step: float = 0.05, trees: int = 200) -> dict[str, Estimator]:
    """The default field of a sweep: boosted trees, a forest and the linear family."""
    return {"gbt": gbt(label, rounds=rounds, step=step), "random_forest": random_forest(label, trees=trees), **linear_models(n_rows, label)}


def sweep_board(predictions: DataFrame, failures: dict[str, str]) -> DataFrame:
    """Models by validation MAE, all scored in one grouped pass; failed ones last, with null metrics and their reason."""
    board = sweep_metrics(predictions).withColumn("failure", F.lit(None).cast("string"))
    lost = predictions.sparkSession.createDataFrame(sorted(failures.items()), "model string, failure string")
    # one row per model of the sweep
    place = F.row_number().over(Window.orderBy(F.col("val_mae").asc_nulls_last(), "model"))
    return board.unionByName(lost, allowMissingColumns=True).withColumn("place", F.when(F.col("failure").isNull(), place))


def regime_predictions(model: PipelineModel, data: DataFrame, keys: Sequence[str] = (HOUR, KEY)) -> DataFrame:
    """Rows (keys, split, y, prediction, probability array)."""
    return model.transform(data).select(
        *keys, "split", F.col("regime").alias("y"), F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability").alias("probability"),
    )


def with_regime(data: DataFrame, spread: str = SPREAD) -> DataFrame:
    return data.withColumn("regime", regime(F.col(spread)))


def feature_importance(spark: SparkSession, models: Sequence[PipelineModel], features: Sequence[str], k: int = 20) -> DataFrame:
    """The k most important features, averaged over the models (e.g. the two stages).

    A model holds one number per feature, so these tables are as small as the feature list.
    """
    rows = [
        (name, float(weight))
        for model in models
        for name, weight in zip(features, model.stages[-1].featureImportances.toArray())
    ]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.groupBy("feature").agg(F.avg("importance").alias("importance")).orderBy(F.desc("importance"), "feature").limit(k)


def naive_predictions(data: DataFrame, y: str = SPREAD, ts: str = HOUR, key: str = KEY) -> DataFrame:
    """Three comparators in long form: previous value, the value 24 rows back, the entity's training mean.

    Rows without a prediction (the first of an entity) are left out.
    """
    lagged = lag_features(data.select(ts, key, "split", y), y, (1, 24), key, ts)
    # stored first: its size, not a guess, decides whether the panel is shuffled for it
    means = materialise(train_rows(data).groupBy(key).agg(F.avg(y).alias("_mean")), "means")
    wide = lagged.join(means, key, "left")
    return wide.select(
        ts, key, "split",
        F.inline(F.array(*[
            F.struct(F.lit(name).alias("model"), F.col(y).alias("y"), F.col(c).alias("prediction"))
            for name, c in (("previous", f"{y}_lag_1"), ("day_back", f"{y}_lag_24"), ("key_mean", "_mean"))
        ])),
    ).filter(F.col("prediction").isNotNull())


def group_mean_predictions(data: DataFrame, label: str, by: Sequence[str], out: str) -> DataFrame:
    """Training mean per group, the overall training mean where a group has no training rows."""
    train = train_rows(data)
    means = materialise(train.groupBy(*by).agg(F.avg(label).alias("_group")), "means")
    overall = train.agg(F.avg(label).alias("m")).scalar()
    return data.join(means, list(by), "left").withColumn(out, F.coalesce("_group", overall)).drop("_group")


def two_stage(da: DataFrame, rt: DataFrame, keys: Sequence[str] = (HOUR, KEY)) -> DataFrame:
    """Spread prediction from separately predicted day-ahead and real-time prices.

    Inputs hold (keys, split, y, prediction) of each component.
    """
    left = da.select(*keys, "split", F.col("y").alias("da_y"), F.col("prediction").alias("da_pred"))
    right = rt.select(*keys, F.col("y").alias("rt_y"), F.col("prediction").alias("rt_pred"))
    return left.join(right, list(keys)).withColumns(
        {"y": F.col("da_y") - F.col("rt_y"), "prediction": F.col("da_pred") - F.col("rt_pred")}
    )


def two_stage_group_means(data: DataFrame, by: Sequence[str]) -> DataFrame:
    """Two stages whose components are training means per group."""
    both = group_mean_predictions(group_mean_predictions(data, DAM, by, "da_pred"), RTM, by, "rt_pred")
    return both.withColumns({"y": F.col(DAM) - F.col(RTM), "prediction": F.col("da_pred") - F.col("rt_pred")})


QUANTILES = {0.1: "p10", 0.5: "p50", 0.9: "p90"}


def quantile_by_group(data: DataFrame, y: str = SPREAD, by: Sequence[str] = (KEY,)) -> DataFrame:
    """p10, p50 and p90 of the training rows of each group, attached to all rows."""
    fitted = materialise(quantile_columns(exact_quantiles(train_rows(data), [y], list(QUANTILES), by), QUANTILES, by), "quantiles")
    return data.join(fitted, list(by), "left")


def quantile_forest(data: DataFrame, features: Sequence[str], forest: RandomForestRegressor, y: str = SPREAD, names: dict[float, str] = QUANTILES) -> DataFrame:
    """Quantiles given the features: the training quantiles of a row's leaf in each tree, averaged over the trees.

    Leaf quantiles are exact and come from all training rows. Rows keep all columns; names of quantiles are added.
    """
    assemble = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    model = forest.fit(train_rows(assemble.transform(data)))
    rows = materialise(leaves(model, assemble.transform(data)).drop("features", "prediction"), "leaves")
    member = train_rows(rows).select(F.col(y).cast("double").alias("_y"), F.posexplode("leaves").alias("tree", "leaf"))
    cuts = quantile_columns(exact_quantiles(member, ["_y"], list(names), ["tree", "leaf"]), names, ["tree", "leaf"])
    # one list per tree, in order of the leaf: as large as the forest, not as the data
    by_leaf = F.map_from_entries(F.collect_list(F.struct("leaf", F.array(*names.values()).alias("cuts"))))
    per_tree = cuts.groupBy("tree").agg(by_leaf.alias("by_leaf"))
    table = materialise(per_tree.agg(F.map_from_entries(F.collect_list(F.struct("tree", "by_leaf"))).alias("forest")), "forest-quantiles")
    held = F.transform("leaves", lambda leaf, tree: F.col("_q.forest")[tree][leaf])
    with_cuts = attach_row(rows, table, "_q").withColumn("_held", held).drop("_q")
    mean = lambda i: F.aggregate("_held", F.lit(0.0), lambda a, x: a + x[i]) / F.size("_held")
    return with_cuts.withColumns({name: mean(i) for i, name in enumerate(names.values())}).drop("_held", "leaves")


def quantile_boosting(
    data: DataFrame, features: Sequence[str], estimator: GBTRegressor, names: dict[float, str] = QUANTILES, patience: int = PATIENCE, gain: float = 0.0,
) -> DataFrame:
    """Quantiles given the features by boosting on the pinball loss. Rows keep all columns; names of quantiles are added."""
    ready = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(data)
    return fit_pinball(ready, estimator, list(names), patience, gain=gain).transform(ready, list(names.values())).drop("features")


def conformal_interval(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Shift each prediction by the quantiles of the validation residuals.

    Takes and keeps (.., split, y, prediction); split-conformal in the sense of Lei et al. 2018. With `by`, each group,
    as a model, has residuals of its own.
    """
    residuals = predictions.filter(F.col("split") == "val").select(*by, (F.col("y") - F.col("prediction")).alias("residual"))
    if by:
        cuts = materialise(quantile_columns(exact_quantiles(residuals, ["residual"], list(QUANTILES), by), QUANTILES, by), "residual-cuts")
        return predictions.join(cuts.withColumnsRenamed({q: f"_{q}" for q in QUANTILES.values()}), list(by), "left").withColumns(
            {q: F.col("prediction") + F.col(f"_{q}") for q in QUANTILES.values()}).drop(*[f"_{q}" for q in QUANTILES.values()])
    cuts = quantile_columns(exact_quantiles(residuals, ["residual"], list(QUANTILES)), QUANTILES, ["column"])
    shifted = {name: F.col("prediction") + F.col(f"_q.{name}") for name in QUANTILES.values()}
    return attach_row(predictions, cuts, "_q").withColumns(shifted).drop("_q")


def normal_interval(data: DataFrame, y: str = SPREAD, by: Sequence[str] = (KEY,)) -> DataFrame:
    """Training mean of the group with a 95% normal interval around it."""
    fitted = materialise(train_rows(data).groupBy(*by).agg(F.avg(y).alias("prediction"), F.stddev_samp(y).alias("_std")), "intervals")
    return (
        data.join(fitted, list(by), "left")
        .withColumns({"lower": F.col("prediction") - Z95 * F.col("_std"), "upper": F.col("prediction") + Z95 * F.col("_std")})
        .drop("_std")
    )
