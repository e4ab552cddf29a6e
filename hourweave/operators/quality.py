"""Data-quality checks as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourweave.functions.scalar import DAM, RTM, attach_row, present
from hourweave.functions.timeutil import HOUR, KEY
from hourweave.operators.quantiles import exact_quantiles, quantile_columns
from hourweave.operators.windows import global_hours, time_gap_summary, time_gaps


def missing_pct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing share in percent per column, two decimals, one row."""
    return df.agg(*[F.round(F.avg(F.col(c).isNull().cast("double")) * 100, 2).alias(c) for c in columns])


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, non_null, nulls, null_pct, mostly_null) from one pass over the data."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"_{i}") for i, c in enumerate(columns)])
    rows = wide.select(
        "_n",
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("non_null")) for i, c in enumerate(columns)])),
    )
    share = F.try_divide((F.col("_n") - F.col("non_null")) * 100.0, F.col("_n"))
    return rows.select(
        "column", "non_null", (F.col("_n") - F.col("non_null")).alias("nulls"), share.alias("null_pct"), (share > 50).alias("mostly_null")
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample deviation, min, quartiles, max per numeric column."""
    columns = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])
    wide = df.agg(*[
        F.struct(
            F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
        ).alias(f"_{i}")
        for i, c in enumerate(columns)
    ])
    stats = wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))
    quartiles = quantile_columns(
        exact_quantiles(df, columns, [0.25, 0.5, 0.75]), {0.25: "q25", 0.5: "q50", 0.75: "q75"}, ["column"]
    )
    return stats.join(quartiles, "column", "left")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and rows beyond the first of their key. Partial counts absorb hot keys."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def price_availability(df: DataFrame, dam: str = DAM, rtm: str = RTM) -> DataFrame:
    """How many rows have each price and the spread, with the verdict on the spread."""
    n = F.count(F.lit(1))
    both = F.count(F.col(dam) - F.col(rtm))
    sums = df.agg(n.alias("n_rows"), F.count(dam).alias("dam_rows"), F.count(rtm).alias("rtm_rows"), both.alias("spread_rows"))

    def pct(c: str) -> Column:
        return F.try_divide(F.col(c) * 100.0, F.col("n_rows"))

    verdict = (
        F.when(F.col("spread_rows") == 0, "fail").when(F.col("spread_rows") < F.col("n_rows") * 0.5, "warn").otherwise("pass")
    )
    return sums.select(
        "n_rows", "dam_rows", "rtm_rows", "spread_rows",
        pct("dam_rows").alias("dam_pct"), pct("rtm_rows").alias("rtm_pct"), pct("spread_rows").alias("spread_pct"),
        verdict.alias("status"),
    )


def require_columns(df: DataFrame, required: Sequence[str] = (HOUR,)) -> None:
    """Raise if a required column is absent or there are no rows."""
    lacking = [c for c in required if not present(df, [c])]
    if lacking:
        raise ValueError(f"missing required columns: {', '.join(lacking)}")
    if df.isEmpty():
        raise ValueError("the table is empty")


def validation_report(df: DataFrame, grain: Sequence[str] = (HOUR, KEY), dam: str = DAM, rtm: str = RTM) -> DataFrame:
    """Rows (check, value, status) for the seven checks.

    1 rows, 2 required columns, 3 time gaps and duplicates, 4 null columns, 5 spread, 6 numeric
    columns, 7 entities. One wide aggregate feeds all but the gap and duplicate rows. Absent
    columns fail the second check; checks that need them are left out, all others are made.
    """
    ts, key = grain
    lacking = [c for c in (*grain, dam, rtm) if not present(df, [c])]
    columns = df.columns
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    wide = df.agg(
        F.count(F.lit(1)).alias("n"),
        *([F.count_distinct(key).alias("entities")] if key not in lacking else []),
        *([F.count(F.col(dam) - F.col(rtm)).alias("spread")] if not {dam, rtm} & set(lacking) else []),
        *[F.count(c).alias(f"_{i}") for i, c in enumerate(columns)],
    )
    n = F.col("n")

    def row(name: str, value: Column, status: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), status.alias("status"))

    def passed(test: Column, otherwise: str = "fail") -> Column:
        return F.when(test, "pass").otherwise(otherwise)

    some_null = sum((F.when(F.col(f"_{i}") < n, 1).otherwise(0) for i in range(len(columns))), F.lit(0))
    mostly = sum((F.when(F.col(f"_{i}") * 2 < n, 1).otherwise(0) for i in range(len(columns))), F.lit(0))
    base = wide.select(F.inline(F.array(
        row("rows", n, passed(n > 0)),
        row("required_columns", F.lit(len(lacking)), F.lit(f"fail: {', '.join(lacking)}" if lacking else "pass")),
        row("null_columns", some_null, F.lit("info")),
        row("mostly_null_columns", mostly, passed(mostly == 0, "warn")),
        *([row("spread_rows", F.col("spread"), F.when(F.col("spread") == 0, "fail").when(F.col("spread") * 2 < n, "warn").otherwise("pass"))]
          if not {dam, rtm} & set(lacking) else []),
        row("numeric_columns", F.lit(len(numeric)), F.lit("info")),
        *([row("entities", F.col("entities"), F.lit("info"))] if key not in lacking else []),
    )))
    if ts in lacking:
        return base
    gaps = time_gap_summary(time_gaps(global_hours(df, ts), key=[], ts=ts)).select(F.inline(F.array(
        row("time_gaps", F.col("longer_gaps"), passed(F.col("longer_gaps") <= 100, "warn")),
    )))
    copies = None if key in lacking else duplicate_keys(df, grain).select(F.inline(F.array(
        row("duplicates", F.col("duplicates"), passed(F.col("duplicates") == 0)),
    )))
    return base.unionByName(gaps).unionByName(copies) if copies is not None else base.unionByName(gaps)


def drift_psi(train: DataFrame, test: DataFrame, column: str, bins: int = 10, floor: float = 1e-6) -> DataFrame:
    """Population stability index of one column, bins cut at the quantiles of the training rows."""
    probs = [i / bins for i in range(1, bins)]
    names = {p: f"e{i}" for i, p in enumerate(probs)}
    edges = quantile_columns(exact_quantiles(train, [column], probs), names, [])

    def shares(df: DataFrame, name: str) -> DataFrame:
        number = sum((F.when(F.col(column) > F.col(f"_edges.{e}"), 1).otherwise(0) for e in names.values()), F.lit(0))
        counts = attach_row(df.filter(F.col(column).isNotNull()), edges, "_edges").select(number.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("c"))
        total = counts.agg(F.sum("c").alias("t")).scalar()
        return counts.select("bin", (F.col("c") / total).alias(name))

    both = shares(train, "expected").join(shares(test, "actual"), "bin", "full")
    a, e = (F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(floor)) for c in ("actual", "expected"))
    return both.agg(F.count(F.lit(1)).alias("bins"), F.sum((a - e) * F.log(a / e)).alias("psi"))
