"""Evaluation of point, class and interval predictions as grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourweave.operators.quantiles import exact_quantiles
from hourweave.session import materialise

MAPE_EPSILON = 1e-10


def regression_metrics(df: DataFrame, y: str = "y", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """rmse, mae, mape (in percent, denominator |y| + 1e-10) and r2 per group.

    The total sum of squares is the count times the population variance of y, which Spark
    accumulates around a running mean, so one pass suffices.
    """
    err = F.col(y) - F.col(pred)
    scored = df.filter(F.col(y).isNotNull() & F.col(pred).isNotNull())
    sums = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(err * err).alias("_mse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.avg(F.abs(err / (F.abs(F.col(y)) + F.lit(MAPE_EPSILON)))) * 100).alias("mape"),
        F.var_pop(y).alias("_var"),
    )
    return sums.select(
        *by, "n_rows", F.sqrt("_mse").alias("rmse"), "mae", "mape",
        (1 - F.try_divide(F.col("_mse"), F.col("_var"))).alias("r2"),
    )


def mape_masked(df: DataFrame, y: str = "y", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """MAPE in percent over rows whose true value is not 0."""
    share = F.abs(F.try_divide(F.col(y) - F.col(pred), F.col(y)))
    return df.groupBy(*by).agg((F.avg(F.when(F.col(y) != 0, share)) * 100).alias("mape_masked"))


def confusion_counts(df: DataFrame, y: str = "y", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Rows (actual, predicted, n_rows) for the pairs that occur."""
    return (
        df.filter(F.col(y).isNotNull() & F.col(pred).isNotNull())
        .groupBy(*by, F.col(y).alias("actual"), F.col(pred).alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def confusion_matrix(df: DataFrame, labels: int = 4, y: str = "y", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """All labels x labels cells per group, 0 where a pair does not occur."""
    counts = confusion_counts(df, y, pred, by)
    pairs = [(a, p) for a in range(labels) for p in range(labels)]
    # one row per group with its cells side by side, then the cells as rows
    cells = [F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("n_rows"))).alias(f"_{a}_{p}") for a, p in pairs]
    wide = counts.groupBy(*by).agg(*cells)
    return wide.select(*by, F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.coalesce(F.col(f"_{a}_{p}"), F.lit(0)).alias("n_rows")) for a, p in pairs
    ])))


def class_report(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """precision, recall, f1 and support per label that is true or predicted somewhere; 0 for 0/0."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n_rows")).otherwise(F.lit(0))
    sides = counts.select(
        *by,
        F.inline(F.array(
            F.struct(F.col("actual").alias("label"), hit.alias("tp"), F.col("n_rows").alias("support"), F.lit(0).cast("long").alias("claimed")),
            F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("support"), F.col("n_rows").alias("claimed")),
        )),
    )
    sums = sides.groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "claimed")])

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    return sums.select(
        *by, "label",
        ratio(F.col("tp"), F.col("claimed")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("claimed")).alias("f1"),
        "support", "tp",
    )


def classification_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, f1_macro, f1_weighted per group from confusion counts."""
    n = F.sum("support")
    return class_report(counts, by).groupBy(*by).agg(
        n.alias("n_rows"),
        (F.sum("tp") / n).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("f1_weighted"),
    )


def pinball(y: Column, pred: Column, alpha: float) -> Column:
    err = y - pred
    return F.when(err >= 0, err * F.lit(alpha)).otherwise(err * F.lit(alpha - 1))


def interval_coverage(df: DataFrame, low: str, high: str, y: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """Share of true values inside the interval, both ends included."""
    inside = F.col(y).between(F.col(low), F.col(high))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(inside.cast("double")).alias("coverage"))


def _with_median(sums: DataFrame, df: DataFrame, width: Column, name: str, by: Sequence[str]) -> DataFrame:
    """Add the exact median of `width` per group."""
    found = exact_quantiles(df.select(*by, width.alias("width")), ["width"], [0.5], by)
    if not by:
        return sums.withColumn(name, found.select("value").scalar())
    # stored: its size decides how the groups meet
    medians = materialise(found.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("value").alias(name)), "medians")
    same = reduce(lambda a, c: a & c, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    return sums.join(medians, same, "left").drop(*[f"_{c}" for c in by])


def interval_width(df: DataFrame, low: str, high: str, by: Sequence[str] = ()) -> DataFrame:
    """mean, median, population deviation, smallest and largest width, per group of `by`."""
    width = F.col(high) - F.col(low)
    sums = df.groupBy(*by).agg(
        F.avg(width).alias("mean_width"),
        F.stddev_pop(width).alias("std_width"),
        F.min(width).alias("min_width"),
        F.max(width).alias("max_width"),
    )
    return _with_median(sums, df, width, "median_width", by)


def pinball_loss(df: DataFrame, levels: dict[str, float], y: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """Mean pinball loss per quantile column; output `quantile_loss_<column>`."""
    return df.groupBy(*by).agg(*[
        F.avg(pinball(F.col(y), F.col(c), a)).alias(f"quantile_loss_{c}") for c, a in levels.items()
    ])


def quantile_crossing(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How often p10 > p50 or p50 > p90, as a count and in percent of both comparisons."""
    crossed = F.count_if(F.col("p10") > F.col("p50")) + F.count_if(F.col("p50") > F.col("p90"))
    return df.groupBy(*by).agg(
        crossed.alias("quantile_violations"),
        (crossed / (2 * F.count(F.lit(1))) * 100).alias("quantile_violations_pct"),
    )


def calibration_band(coverage: Column, goal: float = 0.8) -> Column:
    """How far coverage is from its goal, in words."""
    off = F.abs(coverage - goal) * 100
    return (
        F.when(off < 2, "excellent")
        .when(off < 5, "good")
        .when(coverage < goal, "under_coverage")
        .when(coverage >= goal, "over_coverage")
    )


def quantile_metrics(df: DataFrame, y: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """One row per group of `by`, evaluating p10, p50 and p90 together."""
    err = F.col(y) - F.col("p50")
    width = F.col("p90") - F.col("p10")
    crossed = F.count_if(F.col("p10") > F.col("p50")) + F.count_if(F.col("p50") > F.col("p90"))
    n = F.count(F.lit(1))
    sums = df.groupBy(*by).agg(
        F.avg(F.abs(err)).alias("mae_p50"),
        F.sqrt(F.avg(err * err)).alias("rmse_p50"),
        (1 - F.try_divide(F.avg(err * err), F.var_pop(y))).alias("r2_p50"),
        F.avg(F.col(y).between(F.col("p10"), F.col("p90")).cast("double")).alias("coverage_80"),
        F.avg(width).alias("interval_mean_width"),
        *[F.avg(pinball(F.col(y), F.col(c), a)).alias(f"quantile_loss_{c}") for c, a in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9))],
        crossed.alias("quantile_violations"),
        (crossed / (2 * n) * 100).alias("quantile_violations_pct"),
    )
    return _with_median(sums, df, width, "interval_median_width", by).withColumn("calibration", calibration_band(F.col("coverage_80")))


def rmse_alert(metrics: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Flag groups whose rmse exceeds the threshold."""
    return metrics.withColumn("alert", F.col("rmse") > F.lit(threshold))
