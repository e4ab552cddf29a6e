"""Document fingerprints by locally consistent parsing.

A text is parsed bottom-up. On each level runs of one symbol become one symbol; then deterministic coin tossing gives
each symbol a label in 0..5 that differs from its left neighbour's and depends on the five symbols up to it only; local
maxima of the labels start the phrases, and a phrase's name is a hash of its symbols. Where a phrase begins depends on
a few symbols around it, so equal substrings get equal phrases inside, wherever they stand in a text.

A fingerprint holds the 64 smallest hashed names of two neighbouring levels: the highest level, up to 4, on which
the text has at least 12 phrases, and the one below. Likeness is the share of equal names among the smallest of both
sets (the resemblance of the phrase sets) on the highest level that both have.

The next document in the order of ids is found without a global sort: ids are cut into ranges at their quantiles, one
shuffle brings each range together, and the first document of a range is sent to the range before it as well.

Defined results: null is the empty text; the empty text has the empty fingerprint, like itself (1.0) and like nothing
else (0.0); null ids come first; rows with equal ids follow each other by a hash of the text; the last document is
followed by the first, a single one by itself; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourweave.llm.common import col, ship_package, slices, texts

SKETCH = 64
TOP_LEVEL = 4
LEAST_PHRASES = 12
NULL_ID = -(1 << 63)
#: Characters parsed at once, both versions of a text together; a longer text is parsed alone.
CHUNK = 1 << 20

_ONE = np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _toss_table(width: int) -> np.ndarray:
    """Label of (symbol, left symbol): twice the lowest differing bit's place, plus the symbol's own bit there."""
    own, left = np.meshgrid(np.arange(width), np.arange(width), indexing="ij")
    differ = own ^ left
    place = np.bitwise_count((differ & -differ) - 1).astype(np.int64)
    return np.where(differ == 0, 0, 2 * place + (own >> place & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table(128)


def labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Coin tossing in four rounds: 64 bits, 7 bits, 4 bits, 3 bits, six labels. Neighbours in a text differ."""
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[first] = names[first] ^ _ONE
    differ = names ^ left
    place = np.bitwise_count((differ & (~differ + _ONE)) - _ONE)
    label = (2 * place + ((names >> place.astype(np.uint64)) & _ONE).astype(np.uint8)).astype(np.uint8)
    for _ in range(3):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        before[first] = label[first] ^ 1
        label = _TOSS[label.astype(np.uint16) << 7 | before]
    return label


def next_level(text: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of the symbols `names`, where `text` tells which text a symbol belongs to (ascending)."""
    n = len(names)
    begins = np.ones(n, bool)
    begins[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(begins)
    run = np.diff(np.append(at, n))
    text, names = text[at], names[at]
    several = run > 1
    names[several] = _mix(names[several] * np.uint64(0x9E3779B97F4A7C15) + run[several].astype(np.uint64))
    first = np.ones(len(text), bool)
    first[1:] = text[1:] != text[:-1]
    label = labels(names, first)
    peak = first.copy()
    peak[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[2:]
    at = np.flatnonzero(peak)
    length = np.diff(np.append(at, len(names)))
    place = (np.arange(len(names)) - np.repeat(at, length)).astype(np.uint64)
    total = np.add.reduceat(_mix(names + place * np.uint64(0xD1B54A32D192ED03)), at)
    return text[at], _mix(total + length.astype(np.uint64))


def fingerprints(values: list[str]) -> list[str]:
    """`level:names` of two levels, names as base64 of ascending 32-bit integers."""
    points = [np.frombuffer(v.encode("utf-32-le", "surrogatepass"), "<u4") for v in values]
    sizes = np.array([len(p) for p in points], np.int64)
    text = np.repeat(np.arange(len(values)), sizes)
    names = _mix(np.concatenate([np.empty(0, "<u4"), *points]).astype(np.uint64) + _ONE)
    kept: list[dict[int, np.ndarray]] = [{} for _ in values]
    for level in range(1, TOP_LEVEL + 1):
        if not len(names):
            break
        text, names = next_level(text, names)
        short = (_mix(names + np.uint64(level)) >> np.uint64(32))
        keys = np.unique(text.astype(np.uint64) << np.uint64(32) | short)
        owner, value = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
        ends = np.searchsorted(owner, np.arange(len(values) + 1))
        # phrases with their repeats, so that a text and a repetitive one of its length stand on the same level
        going = np.bincount(text, minlength=len(values)) >= LEAST_PHRASES
        for i in np.unique(owner):
            if going[i] or not kept[i]:
                kept[i].pop(level - 2, None)
                kept[i][level] = value[ends[i] : min(ends[i + 1], ends[i] + SKETCH)]
        stay = going[text]
        text, names = text[stay], names[stay]
    return [";".join(f"{level}:{base64.b64encode(v.tobytes()).decode()}" for level, v in sorted(k.items(), reverse=True)) for k in kept]


def likeness(a: str, b: str) -> float:
    """Estimated resemblance of two fingerprints, 0 to 1."""
    if a == b:
        return 1.0
    one, two = (dict(p.split(":", 1) for p in x.split(";") if p) for x in (a, b))
    common = one.keys() & two.keys()
    if not common:
        return 0.0
    level = max(common, key=int)
    x, y = (set(np.frombuffer(base64.b64decode(d[level]), "<u4").tolist()) for d in (one, two))
    smallest = sorted(x | y)[:SKETCH]
    return sum(v in x and v in y for v in smallest) / len(smallest)


def edited_text(text: str, following: str) -> str:
    """The last quarter, rounded down, replaced by as many first characters of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, `fingerprint` and `n_chars` of each document; a map over the scan."""
    ship_package(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            values = texts(part.column(1))
            yield pa.record_batch({id_column: part.column(0), "n_chars": pa.array([len(v) for v in values], pa.int64()), "fingerprint": fingerprints(values)})

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(col(id_column), col(text).cast("string")).mapInArrow(run, f"`{id_column}` {kind}, n_chars long, fingerprint string")


def with_following(docs: DataFrame, id_column: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Rows `part, tail, key, tie, id, text`, dealt by `part` and sorted: each range of ids, then (tail = 1) its follower."""
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(col(id_column).cast("long"), F.lit(NULL_ID))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = docs.select(key.alias("key")).agg(F.percentile_approx("key", shares, max(10_000, 20 * ranges)).alias("cuts")).first() if shares else None
    bounds = sorted(set(cuts.cuts or [])) if cuts else []
    part = F.size(F.filter(F.lit(bounds), lambda c: c < F.col("key"))) if bounds else F.lit(0)
    rows = docs.select(key.alias("key"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text")).withColumn("part", part)
    # one row for each range that has documents: its smallest id, and the range before it
    firsts = rows.groupBy("part").agg(F.min("key").alias("key")).withColumn("to", F.lag("part").over(Window.orderBy("part")))
    firsts = firsts.withColumn("to", F.coalesce("to", F.max("part").over(Window.partitionBy())))
    heads = rows.join(F.broadcast(firsts.select(F.col("key").alias("head"), "to")), F.col("key") == F.col("head"))
    heads = heads.groupBy("to", "key").agg(F.min(F.struct(F.xxhash64("text").alias("tie"), "text")).alias("h"))
    columns = ["part", "tail", "key", "tie", "text"]
    dealt = rows.withColumns({"tail": F.lit(0), "tie": F.xxhash64("text")}).select(*columns)
    dealt = dealt.unionByName(heads.select(F.col("to").alias("part"), F.lit(1).alias("tail"), "key", "h.tie", "h.text"))
    return dealt.repartitionById(ranges, F.col("part")).sortWithinPartitions("part", "tail", "key", "tie")


def compare_with_following(docs: DataFrame, id_column: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Per document: `n_chars`, `edited_sha256`, `fingerprint`, `edited_fingerprint`, `near_edited`, `near_next`."""
    ship_package(docs.sparkSession)
    schema = f"`{id_column}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def results(rows: list[tuple[int, int, str]]) -> Iterator[pa.RecordBatch]:
        """Of all rows but the last, which only follows; rows are (tail, key, text) of one range."""
        values = [r[2] for r in rows]
        edits = [edited_text(a, b) for a, b in zip(values, values[1:])]
        found = fingerprints(values + edits)
        own, edited = found[: len(values)], found[len(values) :]
        yield pa.record_batch({
            id_column: pa.array([None if r[1] == NULL_ID else r[1] for r in rows[:-1]], pa.int64()),
            "n_chars": pa.array([len(v) for v in values[:-1]], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], pa.string()),
            "fingerprint": pa.array(own[:-1], pa.string()), "edited_fingerprint": pa.array(edited, pa.string()),
            "near_edited": pa.array([likeness(a, b) for a, b in zip(own, edited)], pa.float64()),
            "near_next": pa.array([likeness(a, b) for a, b in zip(own, own[1:])], pa.float64()),
        })

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, str]] = []
        size = 0
        for piece in slices(batches, 64):
            for tail, key, value in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), piece.column(4).to_pylist()):
                rows.append((tail, key, value))
                size += 2 * len(value)
                if tail:
                    yield from results(rows)
                    rows, size = [], 0
                elif size > CHUNK and len(rows) > 1:
                    yield from results(rows)
                    rows, size = rows[-1:], 2 * len(value)

    return with_following(docs, id_column, text, ranges).mapInArrow(run, schema)
