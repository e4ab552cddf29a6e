"""Exact quantiles by radix selection, for groups of any size.

`percentile` keeps every distinct value of a group in one buffer. Here ranks are found piece by piece: the first pass counts
the values of all groups and columns by the leading bits of the long that orders as the double does (its IEEE bits: sign,
exponent and eight bits more, so values over any range spread over it) and keeps the pieces that hold a wanted rank, with
their smallest and largest value. Each further pass compares values with these ends only and cuts every kept piece into
`PARTS` equal ones. A piece of one value needs no further pass, however many rows have it; passes go on until no other kept
piece holds more than `OPEN_ROWS` values, which are then ranked by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourweave.session import materialise

#: Rows of one piece that are ranked by value instead of cut further.
OPEN_ROWS = 100_000
#: Bits below the digit that the first pass counts.
SHIFTS = (44,)
#: Equal parts of a piece in each further pass.
PARTS = 1 << 16


def order_bits(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add a long that orders as the double `value` does; equal codes mean equal values, NaN must not occur.

    The exponent comes from a logarithm and is put right where that is off by one; all divisions are by powers of two.
    """
    size = F.abs(value)
    near = F.floor(F.least(F.greatest(F.coalesce(F.log2(size), F.lit(-1022.0)), F.lit(-1022.0)), F.lit(1023.0))).cast("long")
    shifted = F.when(F.col("_m") >= 2, 1).when((F.col("_m") < 1) & (F.col("_e") > -1022), -1).otherwise(0)
    whole = F.lit(1 << 52)
    code = F.when(size == float("inf"), F.lit(2047) * whole).otherwise(
        (F.col("_e") + F.col("_s") + 1022) * whole + (F.col("_m") / F.when(F.col("_s") == 1, 2.0).when(F.col("_s") == -1, 0.5).otherwise(1.0) * whole).cast("long"))
    return (
        df.withColumn("_e", near).withColumn("_m", F.when(size < float("inf"), size / F.pow(F.lit(2.0), F.col("_e"))).otherwise(1.0))
        .withColumn("_s", shifted).withColumn(name, F.when(F.col(value) < 0, -code).otherwise(code)).drop("_e", "_m", "_s")
    )


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), open_rows: int | None = None,
) -> DataFrame:
    """Long table (by..., column, prob, value), linear interpolation between ranks.

    Nulls and NaN are left out; a column that is all null has no rows. A null is a group of its own. Reads `df` once if every
    kept piece has one value, twice unless another holds more than `open_rows` rows, else once more for each further cut.
    """
    by, open_rows = list(by), OPEN_ROWS if open_rows is None else open_rows
    group = [*by, "column"]
    value = F.when(~F.isnan("v"), F.col("v"))
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(by, list(columns), "column", "v")
    long = long.withColumn("v", value).filter(F.col("v").isNotNull())
    # every rank wanted in a group of n values; which piece holds it follows from the rows before the piece
    ranks = F.array(*[
        F.struct(F.lit(float(p)).alias("prob"), F.lit(side).alias("upper"), (end((F.col("n") - 1) * F.lit(float(p))) + 1).alias("rank"))
        for p in probs
        for side, end in enumerate((F.floor, F.ceil))
    ])
    held = F.filter(ranks, lambda r: r["rank"].between(F.col("before") + 1, F.col("before") + F.col("c")))
    ends = [F.count(F.lit(1)).alias("c"), F.min("v").alias("from"), F.max("v").alias("to")]

    def inside(pieces: DataFrame) -> DataFrame:
        """The rows of kept pieces of several values. Pieces of a group don't overlap, so no row is found twice."""
        mine = [F.col(g).alias(f"_{g}") for g in group]
        # without groups there are at most two pieces per column and probability, hence the broadcast
        lookup = pieces.filter("low < high").select(*mine, "n", "skipped", "low", "high")
        match = F.col("v").between(F.col("low"), F.col("high"))
        for g in group:
            match = match & F.col(g).eqNullSafe(F.col(f"_{g}"))
        return long.join(lookup if by else F.broadcast(lookup), match).drop(*[f"_{g}" for g in group])

    def holding(counted: DataFrame, span: Sequence[str], order: str) -> DataFrame:
        """Counted pieces that hold a wanted rank, with the rows before them in their group."""
        ahead = Window.partitionBy(*span).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return counted.withColumn("before", F.col("skipped") + F.coalesce(F.sum("c").over(ahead), F.lit(0))).filter(F.size(held) > 0)

    def kept(counted: DataFrame, span: Sequence[str]) -> DataFrame:
        return holding(counted, span, "next").select(
            *group, "n", F.col("before").alias("skipped"), F.col("from").alias("low"), F.col("to").alias("high"), "c")

    span = [*group, "n", "skipped", "low", "high"]
    counted = order_bits(long, "v", "code").groupBy(*group, F.shiftright("code", SHIFTS[0]).alias("next")).agg(*ends)
    counted = counted.withColumns({"n": F.sum("c").over(Window.partitionBy(*group)), "skipped": F.lit(0).cast("long")})
    pieces = materialise(kept(counted, group), "quantile-pieces")
    single = F.col("low") == F.col("high")
    while (most := pieces.filter(~single).agg(F.max("c")).first()[0]) is not None and most > open_rows:
        # differences, quotients and products keep the order of values, and the ends fall into different parts
        part = F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * PARTS).alias("next")
        cut = kept(inside(pieces).groupBy(*span, part).agg(*ends), span)
        pieces = materialise(cut.unionByName(pieces.filter(single)), "quantile-pieces")
    # adding to 0.0 turns -0.0 into 0.0
    found = pieces.filter(single).select(*group, "n", (F.lit(0.0) + F.col("low")).alias("v"), F.col("skipped").alias("before"), "c")
    if most is not None:
        ranked = holding(inside(pieces).groupBy(*span, "v").agg(F.count(F.lit(1)).alias("c")), span, "v")
        found = found.unionByName(ranked.select(found.columns))
    found = found.select(*group, "n", "v", F.inline(held))
    lower = F.max(F.when(F.col("upper") == 0, F.col("v")))
    upper = F.max(F.when(F.col("upper") == 1, F.col("v")))
    at = (F.col("n") - 1) * F.col("prob")
    share = at - F.floor(at)
    between = F.when(share == 0, F.col("lower")).otherwise(F.col("lower") + (F.col("upper") - F.col("lower")) * share)
    return (
        found.groupBy(*group, "n", "prob").agg(lower.alias("lower"), upper.alias("upper"))
        .select(*group, "prob", between.alias("value"))
    )


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), accuracy: int = 10000
) -> DataFrame:
    """Same shape from one pass over the data, within n / accuracy ranks."""
    by = list(by)
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        by, list(columns), "column", "v"
    )
    levels = F.array(*[F.lit(float(p)) for p in probs])
    return (
        long.filter(F.col("v").isNotNull())
        .groupBy(*by, "column")
        .agg(F.percentile_approx("v", [float(p) for p in probs], accuracy).alias("q"))
        .select(*by, "column", F.inline(F.arrays_zip(levels.alias("prob"), F.col("q").alias("value"))))
    )


def quantile_columns(quantiles: DataFrame, names: dict[float, str], by: Sequence[str]) -> DataFrame:
    """One row per group of `by` (+ column), one output column per probability."""
    return quantiles.groupBy(*by).agg(
        *[F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(name) for p, name in names.items()]
    )
