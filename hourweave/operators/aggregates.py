"""Hourly roll-ups. Every aggregate here combines map-side before its shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourweave.functions.scalar import present
from hourweave.functions.timeutil import HOUR, KEY


def hourly_mean(df: DataFrame, means: Mapping[str, str], key: Sequence[str] = (KEY,), ts: str = HOUR) -> DataFrame:
    """Mean of each column per hour and key; rows without an hour or key are dropped."""
    have = present(df, list(means))
    return (
        df.dropna(subset=[ts, *key]).groupBy(ts, *key).agg(*[F.avg(c).alias(means[c]) for c in have])
    )


# fixed values: (source column, aggregate, output column) of the constraint roll-up
CONSTRAINT_AGGREGATES = (
    ("ShadowPrice", "max", "ShadowPrice_HourlyMax"),
    ("ShadowPrice", "avg", "ShadowPrice_HourlyAvg"),
    ("Limit", "avg", "ConstraintLimit_HourlyAvg"),
    ("Value", "avg", "ConstraintFlow_HourlyAvg"),
    ("ViolatedMW", "max", "ConstraintViolation_HourlyMax"),
)


def constraint_hourly(df: DataFrame, ts: str = HOUR, key: str = "ConstraintName") -> DataFrame:
    """Max and mean per hour and constraint, over the columns the feed has; `n_intervals` counts its rows."""
    have = set(present(df, [c for c, _, _ in CONSTRAINT_AGGREGATES]))
    aggregates = [getattr(F, how)(c).alias(out) for c, how, out in CONSTRAINT_AGGREGATES if c in have]
    return (
        df.dropna(subset=[ts, key]).groupBy(ts, key).agg(*aggregates, F.count(F.lit(1)).alias("n_intervals"))
    )


def constraint_system(hourly: DataFrame, ts: str = HOUR) -> DataFrame:
    """Per hour over all constraints: highest and row-weighted mean shadow price, number binding."""
    weighted = F.sum(F.col("ShadowPrice_HourlyAvg") * F.col("n_intervals"))
    rows = F.sum(F.when(F.col("ShadowPrice_HourlyAvg").isNotNull(), F.col("n_intervals")))
    return hourly.groupBy(ts).agg(
        F.max("ShadowPrice_HourlyMax").alias("System_ShadowPrice_Max"),
        F.try_divide(weighted, rows).alias("System_ShadowPrice_Avg"),
        F.max("ConstraintViolation_HourlyMax").alias("System_Violation_Max"),
        F.count(F.lit(1)).alias("Binding_Constraints"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(f"n_{c}") for c in columns])


def date_range(df: DataFrame, ts: str = HOUR) -> DataFrame:
    """First and last time and the whole days between them."""
    span = df.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    return span.withColumn("span_days", F.timestamp_diff("DAY", F.col("first_ts"), F.col("last_ts")))


def value_counts(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values; ties in value order."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), column)
        .limit(k)
    )


def regime_distribution(df: DataFrame, column: str = "regime") -> DataFrame:
    """Rows and share in percent per regime."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows").alias("total")).scalar()
    return counts.withColumn("pct", F.col("n_rows") / total * 100)


def prediction_summary(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, smallest and largest value."""
    return df.groupBy(*by).agg(
        F.count(column).alias("n_rows"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
