"""WARC archives and a Merkle audit of their replicas.

`write_warc` stores records in WARC/1.1 files and returns the index `file, offset, length` of each. With `compress` each record
is a gzip member of its own, as the format foresees; `offset` and `length` then still count record bytes, and `at` and
`stored` tell where the member lies. For an audit every replica's records are read by that index and hashed where they lie; hashes are rolled up into a tree over the file's
byte offsets: a leaf range is `range_bytes` long, a node stands for `fan` neighbouring ones, and its hash covers the
ordered hashes below it, up to one root for each file. `audit` compares roots, then only the children of nodes that
differ, level by level, and last the records of the ranges found, so intact branches cost nothing beyond their root.

Files are written under names of their own and renamed, so repeated tasks leave whole, equal files. A file's hot part is
no hot key: hashes are grouped by (file, range).

Defined results: null and empty payloads are records of length 0; a null url leaves the target header out; records
without an archive number are spread over `SPARE` files by a hash; repeated rows are records of their own; a record
that ends beyond its replica's file is hashed as far as it goes, `missing` if nothing is left or the file is not there;
an empty table gives no file and no row; other columns are not stored.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from contextlib import ExitStack

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourweave.llm.common import col, ship_package, slices
from hourweave.llm.files import open_ranges, publish
from hourweave.session import materialise

RANGE_BYTES = 1 << 16
FAN = 16
SPARE = 64
DATE = "2024-01-01T00:00:00Z"

INDEX = "id long, file string, offset long, length long, at long, stored long"


def record(key: int | None, url: str | None, payload: bytes, date: str = DATE) -> bytes:
    """One resource record."""
    lines = [
        "WARC/1.1", "WARC-Type: resource", f"WARC-Record-ID: <urn:record:{'none' if key is None else key}>", f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {url}"] if url is not None else []), "Content-Type: text/html",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}", f"Content-Length: {len(payload)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def write_warc(
    pages: DataFrame, folder: str, archive: Column, id_column: str = "page_id", url: str = "url", payload: str = "html", damaged: Column | None = None,
    compress: bool = False, pristine: str | None = None,
) -> DataFrame:
    """Write the records of each archive number to `folder`, in the order of ids, and return the index, stored.

    `damaged` marks records of which one stored bit in the middle is turned, to rehearse an audit; `pristine` is a second
    folder that gets the same files without the damage, from the same shuffle.
    """
    ship_package(pages.sparkSession)
    body = F.coalesce(col(payload).cast("binary"), F.lit(b""))
    spare = -1 - F.pmod(F.xxhash64(col(url), body), F.lit(SPARE))
    rows = pages.select(
        F.coalesce(archive.cast("long"), spare).alias("archive"), col(id_column).cast("long").alias("id"), col(url).cast("string").alias("url"),
        body.alias("body"), (F.lit(False) if damaged is None else F.coalesce(damaged, F.lit(False))).alias("damaged"))
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("tie", F.xxhash64("body")).repartition(parts, "archive").sortWithinPartitions("archive", "id", "url", "tie")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ExitStack() as files:
            current, offset, at, outs, suffix = None, 0, 0, [], ".gz" if compress else ""
            for part in slices(batches, 64):
                index = []
                for archive, key, target, data, broken in zip(*(part.column(k).to_pylist() for k in range(5))):
                    if archive != current:
                        files.close()
                        current, offset, at = archive, 0, 0
                        name = f"records-{archive:09d}.warc" if archive >= 0 else f"records-spare-{-1 - archive:03d}.warc"
                        outs = [files.enter_context(publish(f"{to}/{name}{suffix}")) for to in (folder, pristine) if to]
                    raw = record(key, target, data)
                    kept = gzip.compress(raw, 6, mtime=0) if compress else raw
                    middle = len(kept) // 2
                    outs[0].write(kept[:middle] + bytes([kept[middle] ^ 1]) + kept[middle + 1 :] if broken else kept)
                    for out in outs[1:]:
                        out.write(kept)
                    index.append((key, name, offset, len(raw), at, len(kept)))
                    offset += len(raw)
                    at += len(kept)
                if index:
                    kinds = (pa.int64(), pa.string(), *[pa.int64()] * 4)
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*index), kinds)], names=["id", "file", "offset", "length", "at", "stored"])

    return materialise(rows.mapInArrow(run, INDEX), "warc-index")


def _unpacked(data: bytes) -> bytes | None:
    try:
        return gzip.decompress(data)
    except (OSError, EOFError, zlib.error):
        return None


def hash_records(index: DataFrame, folder: str, compress: bool = False) -> DataFrame:
    """`index` with `stored_sha256` of each record's stored bytes in `folder`, null if none are there, and `sha256` of the
    record itself, null also if they cannot be unpacked; stored."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024):
            hashes, inner = [], []
            with ExitStack() as files:
                name = handle = None
                for file, offset, length in zip(*(part.column(k).to_pylist() for k in (1, 4, 5))):
                    if file != name:
                        files.close()
                        try:
                            name, handle = file, files.enter_context(open_ranges(f"{folder}/{file}{'.gz' if compress else ''}"))
                        except FileNotFoundError:
                            handle = None
                    data = b"" if handle is None or offset >= handle.size() else handle.read_at(length, offset)
                    hashes.append(hashlib.sha256(data).hexdigest() if data else None)
                    whole = _unpacked(data) if compress and data else data
                    inner.append(hashlib.sha256(whole).hexdigest() if whole else None)
            columns = [pa.array(x, pa.string()) for x in (hashes, inner)]
            yield pa.RecordBatch.from_arrays([*part.columns[:4], *columns], names=["id", "file", "offset", "length", "stored_sha256", "sha256"])

    ship_package(index.sparkSession)
    schema = "id long, file string, offset long, length long, stored_sha256 string, sha256 string"
    return materialise(index.select("id", "file", "offset", "length", "at", "stored").mapInArrow(run, schema), "record-hashes")


def build_tree(records: DataFrame, range_bytes: int = RANGE_BYTES, fan: int = FAN) -> list[DataFrame]:
    """Levels of `file, place, hash`, from the byte ranges up to one root per file; each level stored.

    A range has at most range_bytes / 1 records, a node at most `fan` children, so no group grows with the file.
    """
    text = lambda x: F.concat_ws(":", x["offset"], x["length"], F.coalesce(x["stored_sha256"], F.lit("-")))
    ordered = F.sort_array(F.collect_list(F.struct("offset", "length", "stored_sha256")))
    level = records.groupBy("file", F.floor(F.col("offset") / range_bytes).alias("place")).agg(F.sha2(F.array_join(F.transform(ordered, text), "\n"), 256).alias("hash"))
    levels = [materialise(level, "merkle-level")]
    top = levels[0].agg(F.max("place")).first()[0] or 0
    while top:
        below = F.sort_array(F.collect_list(F.struct("place", "hash")))
        joined = F.array_join(F.transform(below, lambda x: F.concat_ws(":", x["place"], x["hash"])), "\n")
        level = levels[-1].groupBy("file", F.floor(F.col("place") / fan).alias("up")).agg(F.sha2(joined, 256).alias("hash"))
        levels.append(materialise(level.withColumnRenamed("up", "place"), "merkle-level"))
        top //= fan
    return levels


def _differing(one: DataFrame, two: DataFrame, keys: list[str], value: str) -> DataFrame:
    a, b = one.select(*keys, F.col(value).alias("in_one"), F.lit(True).alias("of_one")), two.select(*keys, F.col(value).alias("in_two"), F.lit(True).alias("of_two"))
    return a.join(b, keys, "full").where(~F.col("in_one").eqNullSafe(F.col("in_two")) | F.col("of_one").isNull() | F.col("of_two").isNull())


def audit(one: DataFrame, two: DataFrame, range_bytes: int = RANGE_BYTES, fan: int = FAN) -> DataFrame:
    """`file, offset, status` of the records that differ between two hashed replicas: corrupt, missing (in two) or extra."""
    trees = [build_tree(x, range_bytes, fan) for x in (one, two)]
    height = max(map(len, trees))
    # a replica with shorter files has fewer levels; its root is carried up
    levels = [[t[min(k, len(t) - 1)] for t in trees] for k in range(height)]
    suspects = None
    for k in reversed(range(height)):
        a, b = levels[k]
        if suspects is not None:
            a, b = (x.join(suspects, (x["file"] == suspects["of"]) & (F.floor(x["place"] / fan) == suspects["node"]), "left_semi") for x in (a, b))
        suspects = materialise(_differing(a, b, ["file", "place"], "hash").select(F.col("file").alias("of"), F.col("place").alias("node")), "suspects")
    within = lambda x: x.join(suspects, (x["file"] == suspects["of"]) & (F.floor(x["offset"] / range_bytes) == suspects["node"]), "left_semi")
    found = _differing(within(one), within(two), ["file", "offset"], "stored_sha256")
    status = F.when(F.col("of_one").isNull(), "extra").when(F.col("in_two").isNull(), "missing").otherwise("corrupt")
    return found.select("file", "offset", status.alias("status"))


def fixity_report(index: DataFrame, folder: str, replica: str, compress: bool = False) -> DataFrame:
    """Every record of the index: id, `file`, `offset`, `length`, `sha256` in `folder`, and the `status` of `replica`."""
    one, two = hash_records(index, folder, compress), hash_records(index, replica, compress)
    found = audit(one, two)
    return one.join(found, ["file", "offset"], "left").select("id", "file", "offset", "length", "sha256", F.coalesce("status", F.lit("intact")).alias("status"))


def unindexed_bytes(index: DataFrame, folder: str, compress: bool = False) -> DataFrame:
    """Files of the index that are longer in `folder` than their records: `file`, `size`, `indexed` and `unindexed` bytes.

    The index fixes where records stand, so an audit of records alone does not see bytes between or behind them. A missing
    file has none; its records are reported as missing.
    """
    ship_package(index.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 256):
            sizes = []
            for file in part.column(0).to_pylist():
                try:
                    with open_ranges(f"{folder}/{file}{'.gz' if compress else ''}") as handle:
                        sizes.append(handle.size())
                except FileNotFoundError:
                    sizes.append(0)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), part.column(1)], names=["file", "size", "indexed"])

    files = index.groupBy("file").agg(F.sum("stored").alias("indexed")).repartition("file")
    found = files.mapInArrow(run, "file string, size long, indexed long")
    return found.where("size > indexed").withColumn("unindexed", F.col("size") - F.col("indexed"))


def report_sql(per_file: int, damaged: str, date: str = DATE) -> str:
    """The expected report of `pages` as DuckDB SQL."""
    line = "chr(13) || chr(10)"
    return f"""
WITH raw AS (
  SELECT page_id, 'records-' || lpad((page_id // {per_file})::VARCHAR, 9, '0') || '.warc' AS file,
         'WARC/1.1' || {line} || 'WARC-Type: resource' || {line} || 'WARC-Record-ID: <urn:record:' || page_id || '>' || {line}
         || 'WARC-Date: {date}' || {line} || CASE WHEN url IS NULL THEN '' ELSE 'WARC-Target-URI: ' || url || {line} END
         || 'Content-Type: text/html' || {line} || 'WARC-Payload-Digest: sha256:' || sha256(coalesce(html, '')) || {line}
         || 'Content-Length: ' || strlen(coalesce(html, '')) || {line} || {line} || coalesce(html, '') || {line} || {line} AS record
  FROM pages)
SELECT page_id, file, (coalesce(sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS "offset",
       strlen(record)::BIGINT AS length, sha256(record) AS sha256, CASE WHEN {damaged} THEN 'corrupt' ELSE 'intact' END AS status
FROM raw"""
