"""Positions, cuts and samples without sorting the data as a whole.

Positions are found in two levels: rows are counted per bucket (an order-preserving
coarsening such as the hour), the small bucket table is summed up, and only the rows
of the bucket a cut falls into are ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourweave.functions.scalar import attach_row, bin_number, order_code
from hourweave.functions.timeutil import HOUR, KEY, floor_day, floor_hour

Cut = Callable[[Column], Column]


def cut_points(
    df: DataFrame, bucket: Column, order: Sequence[str], cuts: Sequence[Cut], levels: int = 1, bins: int = 65_536
) -> DataFrame:
    """One row (c0, c1, ...): per cut, the order tuple of the last row on its left side.

    Each cut maps the row count to the number of rows on the left; a cut of 0 gives NULL.
    Also holds t0, t1, ...: how many rows equal to that tuple belong on the left.

    Rows whose bucket is null come last. The running sum runs over one row per bucket, so `bucket` must have a bounded number
    of values: hours of the history, or the values of a short hash prefix. A bucket with a
    large part of all rows is narrowed `levels` times by binning the order columns, so that
    only the tuples of one small bin are ranked.
    """
    codes, exact = [], True
    for c in order:
        if not exact:
            break
        code, exact = order_code(df, c)
        codes.append(code)
    rows = df.select(bucket.alias("_b"), F.struct(*order).alias("_o"), *[c.alias(f"_k{i}") for i, c in enumerate(codes)])
    every = range(len(codes))
    extent = [f(f"_k{i}").alias(f"_{n}{i}") for i in every for n, f in (("lo", F.min), ("hi", F.max))]
    bounds = [f"_{n}{i}" for i in every for n in ("lo", "hi")]

    counts = rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"), *extent)
    whole = Window.orderBy(F.col("_b").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = Window.orderBy(F.col("_b").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = F.array(*[
        F.struct(F.lit(i).alias("cut"), cut(F.col("_n")).cast("long").alias("_r")) for i, cut in enumerate(cuts)
    ])
    spans = _holding_rank(
        counts.withColumn("_upto", F.sum("_c").over(so_far)).withColumn("_n", F.sum("_c").over(whole)).select("*", F.inline(wanted))
    ).select("_b", "cut", "_r", *bounds)
    span = spans.columns

    def inside() -> DataFrame:
        # one span per cut, so the broadcast is bounded by len(cuts)
        joined = rows.join(F.broadcast(spans.withColumnRenamed("_b", "_sb")), F.col("_b").eqNullSafe(F.col("_sb"))).drop("_sb")
        for i in every:
            joined = joined.filter((F.col(f"_k{i}") >= F.col(f"_lo{i}")) & (F.col(f"_k{i}") <= F.col(f"_hi{i}")))
        return joined

    def ranked(pieces: DataFrame, by: str) -> DataFrame:
        upto = Window.partitionBy("cut").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return _holding_rank(pieces.withColumn("_upto", F.sum("_c").over(upto)))

    # a later column may only be binned once all rows left agree on the earlier ones
    part = F.lit(0)
    for i in reversed(every):
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        part = F.when(high > low, bin_number(F.col(f"_k{i}"), low, high, bins)).otherwise(part)
    for _ in range(levels):
        tighter = [f(f"_k{i}").alias(f"_new_{n}{i}") for i in every for n, f in (("lo", F.min), ("hi", F.max))]
        pieces = inside().groupBy(*span, part.alias("_part")).agg(F.count(F.lit(1)).alias("_c"), *tighter)
        spans = ranked(pieces, "_part").select("_b", "cut", "_r", *[F.col(f"_new{c}").alias(c) for c in bounds])

    last = ranked(inside().groupBy("cut", "_r", "_o").agg(F.count(F.lit(1)).alias("_c")), "_o")
    columns = []
    for i in range(len(cuts)):
        mine = F.col("cut") == i
        columns.append(F.max(F.when(mine, F.col("_o"))).alias(f"c{i}"))
        columns.append(F.max(F.when(mine, F.col("_r"))).alias(f"t{i}"))
    return last.agg(*columns)


def _holding_rank(pieces: DataFrame) -> DataFrame:
    """Pieces (_c rows each, _upto including them) that hold rank _r, which then counts from their start."""
    before = F.col("_upto") - F.col("_c")
    return pieces.filter((F.col("_r") > before) & (F.col("_r") <= F.col("_upto"))).withColumn("_r", F.col("_r") - before)


def _split_cuts(fractions: Sequence[float]) -> list[Cut]:
    """Cumulative row counts, each share floored on its own in double arithmetic."""
    cuts = []
    for i in range(len(fractions)):
        shares = fractions[: i + 1]
        cuts.append(lambda n, s=tuple(shares): sum((F.floor(n * F.lit(f)) for f in s), F.lit(0)))
    return cuts


def _nulls_last(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """`df` with a mark before each column for being null, the names of the marks, and the order with both."""
    late = [f"_late{i}" for i in range(len(columns))]
    marked = df.withColumns({n: F.col(c).isNull() for n, c in zip(late, columns)})
    return marked, late, [x for pair in zip(late, columns) for x in pair]


def chronological_split(
    df: DataFrame,
    fractions: Sequence[float] = (0.8, 0.1),
    names: Sequence[str] = ("train", "val", "test"),
    ts: str = HOUR,
    tie_break: Sequence[str] = (KEY,),
    out: str = "split",
) -> DataFrame:
    """Label rows by position in time, null times last: first floor(0.8 n) train, next floor(0.1 n) val, rest test.

    (ts, *tie_break) must be unique for exact sizes, which `quality.duplicate_keys` checks;
    `chronological_split_copies` handles tables with repeated rows. No row is moved: each is
    compared with two cut tuples, which arrive as one scalar subquery.
    """
    marked, late, order = _nulls_last(df, [ts, *tie_break])
    cuts = cut_points(marked, floor_hour(ts), order, _split_cuts(fractions))
    here = F.struct(*order)
    label = F.lit(names[-1])
    for i in reversed(range(len(fractions))):
        label = F.when(here <= F.col(f"_edge.c{i}"), F.lit(names[i])).otherwise(label)
    return attach_row(marked, cuts, "_edge").withColumn(out, label).drop("_edge", *late)


def chronological_split_copies(
    df: DataFrame,
    fractions: Sequence[float] = (0.8, 0.1),
    names: Sequence[str] = ("train", "val", "test"),
    ts: str = HOUR,
    tie_break: Sequence[str] = (KEY,),
    out: str = "split",
) -> DataFrame:
    """As `chronological_split`, for tables whose rows may repeat.

    All columns break ties, so what remains tied at a cut are identical copies. Those are
    collapsed to (row, count) before the shuffle and dealt out by count afterwards.
    """
    rest = [c for c in df.columns if c not in (ts, *tie_break)]
    marked, late, order = _nulls_last(df, [ts, *tie_break, *rest])
    k = len(fractions)
    cuts = cut_points(marked, floor_hour(ts), order, _split_cuts(fractions))
    edge = F.col("_edge")
    edged = attach_row(marked, cuts, "_edge")
    here = F.struct(*order)
    at_edge = F.coalesce(
        *[F.when(here.eqNullSafe(edge[f"c{i}"]), F.lit(True)) for i in range(k)], F.lit(False)
    )
    label = F.lit(names[-1])
    for i in reversed(range(k)):
        label = F.when(here <= edge[f"c{i}"], F.lit(names[i])).otherwise(label)
    clear = edged.filter(~at_edge).withColumn(out, label).drop("_edge", *late)

    # copies of a cut tuple: the first t_i of them are left of cut i
    tied = attach_row(
        edged.filter(at_edge).groupBy(*marked.columns).agg(F.count(F.lit(1)).alias("_n")), cuts, "_edge"
    )
    start = F.lit(0).cast("long")
    shares = []
    for i in range(k):
        upto = (
            F.when(here.eqNullSafe(edge[f"c{i}"]), edge[f"t{i}"])
            .when(here < edge[f"c{i}"], F.col("_n"))
            .otherwise(F.lit(0))
        )
        upto = F.greatest(start, F.coalesce(upto, F.lit(0)).cast("long"))
        shares.append(F.struct(F.lit(names[i]).alias(out), (upto - start).alias("_k")))
        start = upto
    shares.append(F.struct(F.lit(names[-1]).alias(out), (F.col("_n") - start).alias("_k")))
    # ten digits per level keep one generator from emitting every copy of a hot row in one go
    dealt = (
        tied.select(*df.columns, F.inline(F.array(*shares)))
        .filter(F.col("_k") > 0)
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_k") - 1) / 100000))))
        .repartition(F.hash(*df.columns, "_block"))
        .withColumn("_m", F.least(F.lit(100000), F.col("_k") - F.col("_block") * 100000))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_m"))))
        .select(*df.columns, out)
    )
    return clear.unionByName(dealt)


def split_ranges(split_df: DataFrame, ts: str = HOUR, split: str = "split") -> DataFrame:
    """Rows, first and last hour per split."""
    return split_df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_hour"), F.max(ts).alias("last_hour")
    )


def hash_sample(df: DataFrame, n: int, keys: Sequence[str], prefix: int = 4) -> DataFrame:
    """Fixed-size sample without replacement: the `n` rows with the smallest md5 of their keys.

    The n-th smallest hash is located through the counts per hash prefix (16**prefix of
    them), so the rows pass through as a filter instead of a sort. `keys` must be unique.
    """
    # each part with its length, so that a missing part cannot be taken for another's
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in keys]
    text = F.concat_ws("|", *parts) if len(keys) > 1 else F.coalesce(F.col(keys[0]).cast("string"), F.lit(""))
    hashed = df.withColumn("_h", F.md5(text))
    size = F.lit(n)
    cuts = cut_points(hashed, F.substring("_h", 1, prefix), ["_h"], [lambda total: F.least(total, size)])
    edge = cuts.select(F.col("c0").alias("edge")).scalar()
    return hashed.filter(F.col("_h") <= edge["_h"]).drop("_h")


def positions(df: DataFrame, key: Sequence[str], order: Sequence[str], bucket: Column, out: str = "_pos") -> DataFrame:
    """0-based position of each row within its key, in `order`.

    Ranks inside (key, bucket) and adds the rows of earlier buckets, so a key that holds a
    third of all rows is spread over its buckets.
    """
    tagged = df.withColumn("_b", bucket)
    counts = tagged.groupBy(*key, "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*key, "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*key, "_b").orderBy(*order)
    return (
        tagged.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, [*key, "_b"])
        .select(*df.columns, (F.col("_off") + F.col("_rn") - 1).alias(out))
    )


def over_segments(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    reach: int,
    columns: Callable[[Window], dict[str, Column]],
    segment_rows: int = 50_000,
) -> DataFrame:
    """Window functions that look back at most `reach` rows, with no window over a whole key.

    A key is cut into segments of `segment_rows` positions. The last `reach` rows of a
    segment are also sent to the next one, where they serve as history and are dropped
    afterwards, so results equal those of a window over the whole key.
    """
    sent, window = segments(df, key, order, bucket, reach, segment_rows)
    return own_rows(sent.withColumns(columns(window)))


def segments(
    df: DataFrame, key: Sequence[str], order: Sequence[str], bucket: Column, reach: int, segment_rows: int = 50_000,
) -> tuple[DataFrame, Window]:
    """The rows of `over_segments` with their history, position (`_pos`) and segment (`_seg`), and the window over a segment."""
    size = max(segment_rows, reach, 1)
    placed = positions(df, key, order, bucket)
    own = F.floor(F.col("_pos") / size)
    near_end = F.col("_pos") % size >= size - reach
    sent = placed.withColumn("_own", own).withColumn(
        "_seg", F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    return sent, Window.partitionBy(*key, "_seg").orderBy("_pos")


def own_rows(sent: DataFrame) -> DataFrame:
    """The rows of `segments` without history and helpers."""
    return sent.filter(F.col("_seg") == F.col("_own")).drop("_seg", "_own", "_pos")


def daily(ts: str = HOUR) -> Column:
    """The usual bucket for `positions`: the day of the row."""
    return floor_day(ts)
