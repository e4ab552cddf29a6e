"""Row-wise building blocks shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAM = "DAM_Price_Hourly"
RTM = "RTM_LMP_HourlyAvg"
RTM_ALT = "RTM_LMP_HourlyAvg_Alt"
SPREAD = "DART"

# fixed values: lower edges of spread regimes 1, 2 and 3
REGIME_EDGES = (10.0, 50.0, 100.0)


def attach_row(df: DataFrame, row: DataFrame, name: str) -> DataFrame:
    """Add the one row of `row` as a struct column: a scalar subquery, so no join and no shuffle of `df`.

    One column however many of its fields are used, which keeps wide plans small.
    """
    return df.withColumn(name, row.select(F.struct(*row.columns).alias("_row")).scalar())


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN marks a missing value in the feeds; make it NULL so averages skip it."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Those of `wanted` the frame has, in the order asked for, names case-insensitive."""
    have = {c.lower() for c in df.columns}
    return [c for c in wanted if c.lower() in have]


def rename_select(df: DataFrame, mapping: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Rename by `mapping` and keep `keep` plus the renamed columns; absent ones are skipped."""
    wanted = present(df, [*keep, *mapping])
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in wanted])


def spread(df: DataFrame, dam: str = DAM, rtm: str = RTM, out: str = SPREAD) -> DataFrame:
    """Day-ahead minus real-time price; rows lacking either are dropped."""
    lacking = [c for c in (dam, rtm) if not present(df, [c])]
    if lacking:
        raise ValueError(f"missing required column: {', '.join(lacking)}")
    return df.withColumn(out, F.col(dam) - F.col(rtm)).dropna(subset=[dam, rtm, out])


def regime(value: Column, edges: Sequence[float] = REGIME_EDGES) -> Column:
    """Index of the bucket the magnitude falls into; NULL for NULL."""
    size = F.abs(value)
    label = F.lit(0)
    for i, edge in enumerate(edges, start=1):
        label = F.when(size >= edge, F.lit(i)).otherwise(label)
    return F.when(value.isNotNull(), label)


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value on one or both sides; NULL stays NULL."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Which of `bins` equal parts of low..high a value falls into; never decreases with the value."""
    share = (value / 2 - low / 2) / (high / 2 - low / 2)
    return F.when(high > low, F.least(F.floor(share * bins), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")


def order_code(df: DataFrame, column: str) -> tuple[Column, bool]:
    """A double that never decreases with the column, and whether equal codes mean equal values.

    Strings are coded by their first six bytes; types without a code get a constant.
    """
    kind = df.schema[column].dataType
    c = F.col(column)
    exact = True
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        code = F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz")).cast("double")
    elif isinstance(kind, T.TimestampType):
        code = F.unix_micros(c).cast("double")
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType, T.BooleanType)):
        code = c.cast("double")
    elif isinstance(kind, T.NumericType):
        code, exact = c.cast("double"), False
    elif isinstance(kind, T.StringType):
        code, exact = F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double"), False
    else:
        code, exact = F.lit(0.0), False
    return F.coalesce(code, F.lit(-1e300)), exact


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """a / (b + 1), NULL where b is -1."""
    return F.try_divide(top, bottom + 1)


def interactions(
    df: DataFrame,
    products: Mapping[str, tuple[str, str]],
    ratios: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Named products and guarded ratios; entries naming an absent column are skipped."""
    made = {}
    for name, (a, b) in products.items():
        if len(present(df, [a, b])) == len({a, b}):
            made[name] = F.col(a) * F.col(b)
    for name, (a, b) in ratios.items():
        if len(present(df, [a, b])) == len({a, b}):
            made[name] = guarded_ratio(F.col(a), F.col(b))
    return df.withColumns(made) if made else df


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly `keep` + `features`, in order; features the frame lacks, or has as null, become 0.0."""
    have = {c.lower() for c in df.columns}
    return df.select(
        *keep,
        *[
            F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c.lower() in have else F.lit(0.0).alias(c)
            for c in features
        ],
    )


def missing_features(df: DataFrame, features: Sequence[str]) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [c for c in features if c.lower() not in have]
