"""Model input: column roles, target encoding, standardisation.

A fit returns a small parameter DataFrame and sees only the rows it is given, so nothing
from validation or test rows can reach it. Parameters are applied by column name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourweave.functions.scalar import DAM, RTM, SPREAD, attach_row, present
from hourweave.functions.timeutil import HOUR

# fixed values: names that may be categorical although numeric, and the cardinality below which they are
CATEGORICAL_NAMES = ("settlementpoint", "constraintname", "regionid", "zone")
CATEGORICAL_BELOW = 50


@dataclass(frozen=True)
class Roles:
    categorical: tuple[str, ...]
    continuous: tuple[str, ...]

    @property
    def features(self) -> tuple[str, ...]:
        return self.categorical + self.continuous


def feature_roles(df: DataFrame, exclude: Sequence[str] = (HOUR, SPREAD, DAM, RTM, "split")) -> Roles:
    """Strings are categorical, everything else continuous.

    Numeric columns with a known categorical name are categorical below `CATEGORICAL_BELOW` distinct values, counted
    exactly up to that number.
    """
    out = {c.lower() for c in exclude}
    fields = [f for f in df.schema.fields if f.name.lower() not in out]
    strings = {f.name for f in fields if isinstance(f.dataType, T.StringType)}
    doubtful = [f.name for f in fields if f.name not in strings and f.name.lower() in CATEGORICAL_NAMES]
    low = {c for c in doubtful if df.select(c).dropna().distinct().limit(CATEGORICAL_BELOW).count() < CATEGORICAL_BELOW}
    categorical = tuple(f.name for f in fields if f.name in strings | low)
    return Roles(categorical, tuple(f.name for f in fields if f.name not in strings | low))


def infer_target(columns: Sequence[str]) -> str:
    """The price to predict, judged by name: `target_price`, else the first LMP column that is called a price, else the first LMP column."""
    if "target_price" in columns:
        return "target_price"
    lmp = [c for c in columns if "lmp" in c.lower()]
    called = [c for c in lmp if any(part in c.lower() for part in ("price", "spp"))]
    if not lmp:
        raise ValueError("no target column recognised")
    return (called or lmp)[0]


def numeric_features(df: DataFrame, target: str) -> list[str]:
    """All numeric columns but the target; the target must have no nulls."""
    if not present(df, [target]):
        raise ValueError(f"missing target column: {target}")
    if not df.filter(F.col(target).isNull()).isEmpty():
        raise ValueError(f"target {target} has nulls")
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != target]


def target_encode_fit(
    train: DataFrame, columns: Sequence[str], target: str = SPREAD, min_samples_leaf: float = 20.0, smoothing: float = 1.0
) -> DataFrame:
    """Rows (feature, category, n, encoding): category mean blended with the overall mean.

    The weight of the category mean is 1 / (1 + exp((min_samples_leaf - n) / smoothing)).
    A row with a null category per feature holds the overall mean, for unseen values.
    """
    prior = train.agg(F.avg(target).alias("prior")).scalar()
    long = train.select(
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in columns
        ])),
        F.col(target).alias("_y"),
    ).filter(F.col("category").isNotNull())
    weight = 1 / (1 + F.exp((F.lit(float(min_samples_leaf)) - F.col("n")) / F.lit(float(smoothing))))
    fitted = (
        long.groupBy("feature", "category")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("_mean"))
        .select("feature", "category", "n", (weight * F.col("_mean") + (1 - weight) * prior).alias("encoding"))
    )
    default = train.agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("encoding")).select(
        F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"),
        F.lit(None).cast("string").alias("category"),
        "n",
        "encoding",
    )
    return fitted.unionByName(default)


def target_encode_apply(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each category by its encoding, unseen and missing ones by the overall mean.

    The parameter side is joined without a hint: Spark broadcasts it while it is small and
    splits skewed categories when it is not.
    """
    out = df
    for c in columns:
        mine = params.filter(F.col("feature") == c)
        default = mine.filter(F.col("category").isNull()).select("encoding").scalar()
        lookup = mine.filter(F.col("category").isNotNull()).select(
            F.col("category").alias("_category"), F.col("encoding").alias("_encoding")
        )
        out = (
            out.join(lookup, F.col(c).cast("string") == F.col("_category"), "left")
            .withColumn(c, F.coalesce("_encoding", default))
            .drop("_category", "_encoding")
        )
    return out


def standardize_fit(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (feature, mean, std): nulls count as 0, population deviation, 1 for a constant column.

    Constant means min = max: the deviation itself may come out as rounding noise.
    """
    wide = train.agg(*[
        F.struct(
            F.lit(c).alias("feature"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), (F.max(x) > F.min(x)).alias("varies")
        ).alias(f"_{i}")
        for i, (c, x) in enumerate((c, F.coalesce(F.col(c).cast("double"), F.lit(0.0))) for c in columns)
    ])
    rows = wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))
    return rows.select("feature", "mean", F.when(F.col("varies"), F.col("std")).otherwise(F.lit(1.0)).alias("std"))


def standardize(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / std with the fitted parameters, nulls as 0. Adds no join: one scalar subquery."""
    one = params.agg(*[
        F.max(F.when(F.col("feature") == c, F.struct("mean", "std"))).alias(f"_{i}") for i, c in enumerate(columns)
    ])
    return attach_row(df, one, "_fitted").withColumns({
        c: (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.col(f"_fitted._{i}.mean")) / F.col(f"_fitted._{i}.std")
        for i, c in enumerate(columns)
    }).drop("_fitted")


def train_rows(df: DataFrame, split: str = "split") -> DataFrame:
    return df.filter(F.col(split) == "train")
