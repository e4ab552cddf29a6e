"""Leaderboards and blends over predictions in the form (keys, split, model, y, prediction)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourweave.functions.scalar import attach_row
from hourweave.functions.timeutil import HOUR, KEY
from hourweave.operators.metrics import regression_metrics


def sweep_metrics(predictions: DataFrame, splits: Sequence[str] = ("val", "test")) -> DataFrame:
    """Per model one row: rmse and mae on each split, from one grouped pass; models are few, rows are not."""
    per_split = regression_metrics(predictions.filter(F.col("split").isin(*splits)), by=["model", "split"])
    return per_split.groupBy("model").agg(*[
        F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}") for s in splits for m in ("rmse", "mae")
    ])


def leaderboard_join(jobs: DataFrame, metrics: DataFrame, on: str = "model") -> DataFrame:
    """Every job with its metrics; jobs without any keep nulls."""
    return jobs.join(metrics, on, "left")


def leaderboard_rank(board: DataFrame, metric: str = "test_mae", name: str = "model") -> DataFrame:
    """Place by ascending metric; unscored models come last and get no medal.

    The window holds one row per model.
    """
    order = Window.orderBy(F.col(metric).asc_nulls_last(), F.col(name))
    place = F.row_number().over(order)
    medal = F.when(F.col(metric).isNotNull() & (F.col("place") <= 3), F.element_at(F.array(*map(F.lit, ("gold", "silver", "bronze"))), F.col("place")))
    return board.withColumn("place", place).withColumn("medal", F.when(F.col("place") <= 3, medal))


def best_model(board: DataFrame, metric: str = "test_mae", name: str = "model") -> DataFrame:
    """The model with the smallest metric, ties by name."""
    best = F.min(F.when(F.col(metric).isNotNull(), F.struct(F.col(metric).alias("metric"), F.col(name).alias("model"))))
    return board.agg(best.alias("b")).filter(F.col("b").isNotNull()).select("b.model", "b.metric")


def leaderboard_summary(board: DataFrame, metric: str = "test_mae") -> DataFrame:
    return board.agg(
        F.count(metric).alias("n_models"),
        F.min(metric).alias("best"),
        F.max(metric).alias("worst"),
        F.avg(metric).alias("mean"),
        (F.max(metric) - F.min(metric)).alias("range"),
    )


def improvement(value: Column, baseline: Column) -> Column:
    """Reduction against the baseline in percent; negative if worse."""
    return F.try_divide(baseline - value, baseline) * 100


def improvement_vs_baseline(board: DataFrame, baseline: float, metric: str = "test_mae") -> DataFrame:
    """The best model's gain over a fixed baseline."""
    best = best_model(board, metric)
    base = F.lit(float(baseline))
    return best.select(
        "model", "metric", base.alias("baseline"),
        (base - F.col("metric")).alias("reduction"),
        improvement(F.col("metric"), base).alias("improvement_pct"),
    )


def ensemble_weights(predictions: DataFrame, split: str = "val") -> DataFrame:
    """Weights 1 / rmse on the validation rows, normalised.

    Models without error share the whole weight. Fewer than two models is an error raised
    when the weights are computed.
    """
    scores = regression_metrics(predictions.filter(F.col("split") == split), by=["model"]).select(
        "model", F.col("rmse").alias("val_rmse")
    )
    totals = scores.agg(
        F.count(F.lit(1)).alias("models"),
        F.count_if(F.col("val_rmse") == 0).alias("perfect"),
        F.sum(F.try_divide(F.lit(1.0), F.col("val_rmse"))).alias("inverse"),
    )
    t = F.col("_totals")
    weight = F.when(
        t["perfect"] > 0, F.when(F.col("val_rmse") == 0, 1 / t["perfect"]).otherwise(F.lit(0.0))
    ).otherwise(F.try_divide(F.lit(1.0), F.col("val_rmse")) / t["inverse"])
    enough = F.when(t["models"] < 2, F.raise_error(F.lit("an ensemble needs at least two models")).cast("double")).otherwise(weight)
    return attach_row(scores, totals, "_totals").withColumn("weight", enough).drop("_totals")


def ensemble_predict(
    predictions: DataFrame, weights: DataFrame | None = None, keys: Sequence[str] = (HOUR, KEY), keep: Sequence[str] = ("split",)
) -> DataFrame:
    """Weighted mean of the models per row, plain mean without weights. Missing models are left out of both sums."""
    if weights is None:
        weighted = predictions.withColumn("weight", F.lit(1.0))
    else:
        # one entry for each model, so the predictions are not dealt by their few model names
        of_model = weights.agg(F.map_from_entries(F.collect_list(F.struct("model", "weight"))).alias("m"))
        weighted = attach_row(predictions, of_model, "_weights").withColumn("weight", F.col("_weights.m")[F.col("model")]).drop("_weights")
        weighted = weighted.filter(F.col("weight").isNotNull())
    return weighted.filter(F.col("prediction").isNotNull()).groupBy(*keys, *keep).agg(
        F.max("y").alias("y"),
        F.try_divide(F.sum(F.col("weight") * F.col("prediction")), F.sum("weight")).alias("prediction"),
    )


def ensemble_output(
    predictions: DataFrame, weights: DataFrame, models: Sequence[str], keys: Sequence[str] = (HOUR, KEY), split: str = "test"
) -> DataFrame:
    """Per row: actual, blend, the blend's validation rmse, and each model's prediction and rmse."""
    val = ensemble_predict(predictions.filter(F.col("split") == "val"), weights, keys)
    blend_rmse = regression_metrics(val).select("rmse").scalar()
    scores = weights.agg(*[F.max(F.when(F.col("model") == m, F.struct("weight", "val_rmse"))).alias(m) for m in models])
    w = F.col("_scores")
    wide = (
        predictions.filter(F.col("split") == split)
        .groupBy(*keys)
        .agg(
            F.max("y").alias("actual"),
            *[F.max(F.when(F.col("model") == m, F.col("prediction"))).alias(f"{m}_prediction") for m in models],
        )
    )
    top = sum((F.coalesce(F.col(f"{m}_prediction") * w[m]["weight"], F.lit(0.0)) for m in models), F.lit(0.0))
    bottom = sum((F.when(F.col(f"{m}_prediction").isNotNull(), w[m]["weight"]).otherwise(0.0) for m in models), F.lit(0.0))
    return attach_row(wide, scores, "_scores").select(
        *keys, "actual",
        F.try_divide(top, bottom).alias("ensemble_prediction"),
        blend_rmse.alias("ensemble_val_rmse"),
        *[c for m in models for c in (F.col(f"{m}_prediction"), w[m]["val_rmse"].alias(f"{m}_val_rmse"))],
    )
