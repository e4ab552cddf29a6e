"""Packing by optimal length buckets.

1. One aggregation gives the histogram of lengths in cells: exact up to `2 ** RESOLUTION`, above that 2 ** RESOLUTION
   cells for each doubling, so the driver gets at most some tens of thousands of numbers for any corpus.
2. Dynamic programming over the cells chooses at most `buckets` bucket tops with the least total padding (every
   document padded to its bucket's longest one). Padding is a line in the top for each lower end, so one pass over a
   lower envelope solves each of the bucket counts.
3. Inside a bucket, rows stand in the order of a hash; positions come from row counts of hash slices (a prefix sum) plus
   the rank inside a slice, so no bucket is sorted in one task. Batch b holds the rows b * capacity up to the next,
   where capacity is what the budget holds of the bucket's top, one at least. The budget is in the unit of `length`:
   op1 and the pipeline count words at ASCII white space, not tokens.

Defined results: null and empty texts have length 0 and are packed like others; a document longer than the budget has
batches of one; ties of the hash are broken by id, equal rows share their set of places; an empty table gives none;
columns of the input are not read but for the id and what `length` needs.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourweave.llm.common import col
from hourweave.session import materialise

BUCKETS = 16
BUDGET = 32_768
RESOLUTION = 12
SLICE_ROWS = 20_000
BROADCAST_SLICES = 100_000


def choose_tops(cells: Sequence[tuple[int, int, int]], buckets: int = BUCKETS) -> tuple[list[int], int]:
    """Tops of at most `buckets` buckets, and the padding, for (longest, count, sum of lengths) of ascending cells."""
    n = len(cells)
    if not n:
        return [], 0
    count, total = [0], [0]
    for _, c, s in cells:
        count.append(count[-1] + c)
        total.append(total[-1] + s)
    best: list[int | None] = [0] + [None] * n
    came: list[list[int]] = []
    answer, levels = None, 0
    for level in range(1, min(buckets, n) + 1):
        lines: deque[tuple[int, int, int]] = deque()  # (count, intercept, cell) of the lower ends that can still be best
        now: list[int | None] = [None] * (n + 1)
        via = [0] * (n + 1)
        for j in range(1, n + 1):
            i = j - 1
            if best[i] is not None:
                c, b = count[i], best[i] + total[i]
                while len(lines) > 1 and (b - lines[-2][1]) * (lines[-1][0] - lines[-2][0]) <= (lines[-1][1] - lines[-2][1]) * (c - lines[-2][0]):
                    lines.pop()
                lines.append((c, b, i))
            if lines:
                top = cells[j - 1][0]
                while len(lines) > 1 and lines[1][1] - lines[1][0] * top <= lines[0][1] - lines[0][0] * top:
                    lines.popleft()
                now[j] = top * count[j] - total[j] + lines[0][1] - lines[0][0] * top
                via[j] = lines[0][2]
        came.append(via)
        best = now
        if answer is None or best[n] < answer:
            answer, levels = best[n], level
        if not answer:
            break
    tops, j = [], n
    for via in reversed(came[:levels]):
        tops.append(cells[j - 1][0])
        j = via[j]
    return tops[::-1], answer


def length_cells(lengths: DataFrame, resolution: int = RESOLUTION) -> list[tuple[int, int, int]]:
    """The histogram of column `length`."""
    width = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.greatest("length", F.lit(1)))) - resolution, F.lit(0))).cast("long")
    cell = F.col("length") - F.pmod("length", width)
    rows = lengths.groupBy(cell.alias("cell")).agg(F.max("length").alias("top"), F.count("*").alias("n"), F.sum("length").alias("total")).collect()
    return sorted((r["top"], r["n"], r["total"]) for r in rows)


def pack(
    docs: DataFrame, length: Column, id_column: str = "doc_id", buckets: int = BUCKETS, budget: int = BUDGET, seed: int = 5,
) -> DataFrame:
    """Per row: id, `length`, `bucket`, `bucket_length`, `batch` and its `place` in the batch.

    Batches are numbered through, bucket after bucket; each but a bucket's last is full.
    """
    lengths = docs.select(col(id_column).alias("id"), F.coalesce(length, F.lit(0)).cast("long").alias("length"))
    lengths = materialise(lengths.withColumn("order", F.xxhash64(F.lit(seed), "id", "length")), "lengths")
    cells = length_cells(lengths)
    tops, _ = choose_tops(cells, buckets)
    counts, at = [], 0
    for top in tops:
        n = 0
        while at < len(cells) and cells[at][0] <= top:
            n += cells[at][1]
            at += 1
        counts.append(n)
    room = [max(1, budget // max(1, top)) for top in tops]
    first = [0]
    for n, r in zip(counts, room):
        first.append(first[-1] + -(-n // r))
    pick = lambda values, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.array(F.lit(0).cast(kind)), F.col("bucket") + 1)
    under = F.array(*[F.lit(t).cast("long") for t in tops]) if tops else F.array().cast("array<bigint>")
    placed = lengths.withColumn("bucket", F.size(F.filter(under, lambda t: t < F.col("length"))))
    placed = placed.withColumn("slice", F.pmod("order", pick([-(-n // SLICE_ROWS) or 1 for n in counts], "long")))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("bucket", "slice").agg(F.count("*").alias("n")).select("bucket", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    slices = sum(-(-n // SLICE_ROWS) for n in counts)
    ranked = placed.withColumn("rank", F.row_number().over(Window.partitionBy("bucket", "slice").orderBy("order", "id")))
    ranked = ranked.join(F.broadcast(bases) if slices <= BROADCAST_SLICES else bases, ["bucket", "slice"])
    at_rank = F.col("base") + F.col("rank") - 1
    capacity = pick(room, "long")
    return ranked.select(
        F.col("id").alias(id_column), "length", "bucket", pick(tops, "long").alias("bucket_length"),
        (pick(first[:-1], "long") + F.floor(at_rank / capacity)).alias("batch"), F.pmod(at_rank, capacity).alias("place"))
