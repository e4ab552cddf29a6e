"""Joins that build the (hour, entity) panel.

No join here forces a broadcast of a table whose size is unknown: Spark's own threshold,
re-checked at run time by adaptive execution, decides between a broadcast and a
sort-merge join with skew handling. A hint is given only when the caller states the hour
range, since an hour-grain table then has a known number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourweave.functions.timeutil import HOUR, KEY

MAX_BROADCAST_HOURS = 200_000

HourRange = tuple[datetime, datetime]


def within(df: DataFrame, span: HourRange | None, ts: str = HOUR) -> DataFrame:
    """Rows with start <= ts < end."""
    if span is None:
        return df
    start, end = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in span)
    return df.filter((F.col(ts) >= start) & (F.col(ts) < end))


def stored_within(df: DataFrame, span: HourRange | None, stored: str) -> DataFrame:
    """Rows whose stored time or day can lie in the range, by bounds on the column itself, which reach the scan.

    Times are kept from the first hour's start to an hour past the end, days from the one before the first, as an hour
    ending label can reach into the next day; `within` on the computed hour is exact.
    """
    if span is None:
        return df
    start, end = span
    kind = df.schema[stored].dataType
    if isinstance(kind, T.DateType):
        low, high = F.lit((start - timedelta(days=1)).date()), F.lit((end + timedelta(days=1)).date())
    else:
        wide = timedelta(days=1) if stored.lower().replace("_", "") in ("deliverydate", "operday") else timedelta(hours=1)
        low, high = (F.lit(t.isoformat(sep=" ")).cast(kind) for t in (start - wide, end + wide))
    return df.filter((F.col(stored) >= low) & (F.col(stored) < high))


def outer_join(frames: Sequence[DataFrame], on: Sequence[str] = (HOUR, KEY)) -> DataFrame:
    """Full outer join of several feeds on the grain; rows with a null key part are dropped first.

    More than two feeds that have unique keys can be stacked and grouped instead, with one shuffle (`stack_join`).
    """
    return reduce(lambda a, b: a.join(b, list(on), "full"), [f.dropna(subset=list(on)) for f in frames])


def stack_join(frames: Sequence[DataFrame], on: Sequence[str] = (HOUR, KEY)) -> DataFrame:
    """Full outer join of feeds in one shuffle: rows are stacked, the other feeds' columns null, and grouped by key.

    A key that a feed repeats is reduced to one row, the smallest value of each column. Rows with a null key part are dropped.
    """
    frames = [f.dropna(subset=list(on)) for f in frames]
    rest = [[c for c in f.columns if c not in on] for f in frames]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.groupBy(*on).agg(*[F.min(c).alias(c) for columns in rest for c in columns])


def join_hourly(panel: DataFrame, tables: Sequence[DataFrame], span: HourRange | None = None, ts: str = HOUR) -> DataFrame:
    """Left join of hour-grain tables onto the panel.

    The tables are reduced to one row per hour together, in one shuffle, so the panel is joined
    once however many there are and never multiplied; a repeated hour keeps the smallest value of
    each column. A column name two tables share is an error.
    """
    tables = list(tables)
    if not tables:
        return panel
    seen: set[str] = {c.lower() for c in panel.columns} - {ts.lower()}
    for table in tables:
        names = {c.lower() for c in table.columns} - {ts.lower()}
        if seen & names:
            raise ValueError(f"ambiguous columns: {', '.join(sorted(seen & names))}")
        seen |= names
    hourly = stack_join([within(t, span, ts) for t in tables], on=[ts])
    if span is not None and (span[1] - span[0]).total_seconds() / 3600 <= MAX_BROADCAST_HOURS:
        hourly = F.broadcast(hourly)
    return panel.join(hourly, ts, "left")


def union_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """Chunks of one table, by column name; a column some chunks lack is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chunks)
