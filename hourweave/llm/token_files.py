"""Token ids as flat binary files.

A folder holds for each range of document ids

- `part-NNNNN.bin`: the ids of its documents one after the other, little-endian unsigned 16-bit integers if the
  vocabulary fits, else 32-bit;
- `part-NNNNN.off`: little-endian 64-bit offsets, one more than documents: document i has ids off[i] to off[i + 1];
- `part-NNNNN.doc`: the document ids, little-endian 64-bit integers, with the smallest one standing for null;

and `manifest`, a Parquet table of `part, documents, tokens, base`: `base` is the number of ids in all earlier parts,
a prefix sum of `tokens`, so a global position is base + offset.

Documents are dealt to parts by ranges of (id, hash of the text) and sorted inside, so the order is ascending ids,
nulls first; rows with the same id follow each other in the order of that hash. Null and empty texts hold the end id
only. Files are written under a name of their own and renamed, so lost or repeated tasks leave whole files.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourweave.llm.common import col, fresh, ship_package, texts
from hourweave.llm.files import open_array, publish
from hourweave.llm.token_counts import load_tokenizer

NULL_ID = -(1 << 63)
#: A space is the start of a pre-token only before a character that is not white space.
_LONE_SPACE = re.compile(r" (?=\s)| $")
#: Chunks a Python worker remembers at most, in two generations: what the older one has and is not met again is forgotten.
CACHE = 1_000_000
#: New chunks that are encoded as one string.
RUN = 256
#: UTF-8 bytes of text a part should not exceed by much.
PART_BYTES = 256 << 20
_cache: dict[tuple, list[dict[str, bytes]]] = {}


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


class Encoder:
    """Byte-level BPE ids of whole texts as bytes.

    The pre-token pattern takes a space together with the run after it, so a text falls apart before each space that
    a non-space follows, whatever stands around it. Such chunks repeat, and are remembered. New ones are encoded many at
    a time, joined as a text would join them: a chunk begins where a token begins with a space, since it has no other.
    """

    def __init__(self, path: str, split: bool = True):
        self.library = load_tokenizer(path)
        self.dtype = id_type(self.library.get_vocab_size())
        if split and not splits_before_spaces(path):
            raise ValueError("this tokenizer's texts do not fall apart before spaces; pass split=False")
        self.split = split
        if split:
            names = self.library.get_vocab(with_added_tokens=False)
            self.starts = np.zeros(max(names.values()) + 1, bool)
            self.starts[[i for name, i in names.items() if name.startswith(SPACE_MARK)]] = True
        self.generations = _cache.setdefault((path, self.dtype), [{}, {}])

    def _all(self, pieces: list[str]) -> list[np.ndarray]:
        return [np.asarray(x.ids, self.dtype) for x in self.library.encode_batch_fast(pieces, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of chunks; those that begin a text are marked by a leading space and stand alone."""
        found: dict[str, bytes] = {}
        first = [p for p in new if p[:1] == " " or p[:1] in _SPECIAL_STARTS]
        inner = [p for p in new if not (p[:1] == " " or p[:1] in _SPECIAL_STARTS)]
        runs = [inner[i : i + RUN] for i in range(0, len(inner), RUN)]
        for run, ids in zip(runs, self._all([" " + " ".join(run) for run in runs])):
            at = np.flatnonzero(self.starts[np.minimum(ids, len(self.starts) - 1)])
            if len(at) == len(run):
                flat, cuts = ids.tobytes(), (at * ids.itemsize).tolist()
                found.update(zip(run, map(flat.__getitem__, map(slice, cuts, [*cuts[1:], len(flat)]))))
            else:  # a chunk holds something that reads as one with its neighbour
                first += run
        found.update(zip(first, (x.tobytes() for x in self._all([p[1:] if p[:1] == " " else " " + p for p in first]))))
        return found

    def _ids_of(self, first: list[str], inner: list[str]) -> list[bytes]:
        """Ids of distinct chunks: those that begin a text, then the others."""
        # a first chunk has no space before it; its key gets one in front, which no other chunk has
        keys = [" " + x for x in first] + inner
        known, old = self.generations
        if len(known) > CACHE // 2:
            known, old = self.generations[:] = {}, known
        ids = list(map(known.get, keys))
        holes = [i for i, x in enumerate(ids) if x is None]
        again = {keys[i]: old[keys[i]] for i in holes if keys[i] in old}
        known.update(again)
        known.update(self._learn([keys[i] for i in holes if keys[i] not in again]))
        for i in holes:
            ids[i] = known[keys[i]]
        return ids

    def encode(self, values: list[str]) -> list[bytes]:
        """Texts are split, and chunks told apart, by Arrow; Python sees each distinct chunk of the batch once."""
        whole = [i for i, text in enumerate(values) if not self.split or _LONE_SPACE.search(text)]
        out = [b""] * len(values)
        for i, own in zip(whole, self._all([values[i] for i in whole])):
            out[i] = own.tobytes()
        if len(whole) == len(values):
            return out
        apart = set(whole)
        rest = [i for i in range(len(values)) if i not in apart]
        pieces = pc.split_pattern(pa.array([values[i] for i in rest], pa.large_string()), " ")
        ends = np.asarray(pieces.offsets)
        coded = pieces.values.dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        begins = np.zeros(len(code), bool)
        begins[ends[:-1]] = True
        # chunks that occur inside texts keep their number; those at the start get numbers behind them
        first, place = np.unique(code[begins], return_inverse=True)
        code[begins] = len(coded.dictionary) + place
        inner = np.flatnonzero(np.bincount(code[~begins], minlength=len(coded.dictionary))[: len(coded.dictionary)])
        ids = self._ids_of(coded.dictionary.take(pa.array(first)).to_pylist(), coded.dictionary.take(pa.array(inner)).to_pylist())
        flat = np.frombuffer(b"".join(ids), self.dtype)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // flat.itemsize
        number = np.concatenate([inner, len(coded.dictionary) + np.arange(len(first))])
        sizes, starts = np.zeros((2, len(coded.dictionary) + len(first)), np.int64)
        order = np.concatenate([np.arange(len(first), len(ids)), np.arange(len(first))])
        sizes[number], starts[number] = size[order], (np.cumsum(size) - size)[order]
        each = sizes[code]
        until = np.concatenate([[0], np.cumsum(each)])
        every = flat[np.repeat(starts[code] - until[:-1], each) + np.arange(until[-1])].tobytes()
        cuts = (until[ends] * flat.itemsize).tolist()
        for i, a, b in zip(rest, cuts, cuts[1:]):
            out[i] = every[a:b]
        return out


def by_size(batches: Iterable[pa.RecordBatch], most: int = 8 << 20, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Slices of about `most` bytes of text, of one row at least."""
    for batch in batches:
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(size, (size[start - 1] if start else 0) + most, "right")))
            yield batch.slice(start, end - start)
            start = end


#: Byte-level tokenizers write a space as this character.
SPACE_MARK = "\u0120"
#: Chunks that could be read together with others: empty ones, and those that may hold added tokens.
_SPECIAL_STARTS = frozenset(("", "<"))
_PROBES = ("a b", "a  b c", " 'll be", "x, y\n z", "\u00e9 \u4e2d 12 3", "a\u00a0b c", "<a b> c", "it's 9 o'clock .")


@lru_cache(maxsize=4)
def splits_before_spaces(path: str) -> bool:
    """Whether the tokenizer is byte-level without a normaliser and cuts texts before each space that a non-space follows."""
    library = load_tokenizer(path)
    kinds = json.loads(library.to_str())
    if kinds.get("normalizer") or (kinds.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or kinds["pre_tokenizer"].get("add_prefix_space"):
        return False
    encode = lambda x: library.encode(x, add_special_tokens=False).ids
    for probe in _PROBES:
        cuts = [0, *[m.start() for m in re.finditer(r" (?=\S)", probe) if m.start()], len(probe)]
        if encode(probe) != [i for a, b in zip(cuts, cuts[1:]) for i in encode(probe[a:b])]:
            return False
    return True


def _write_part(folder: str, tokenizer: str, end: int, split: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        part = TaskContext.get().partitionId()
        encoder = Encoder(tokenizer, split)
        stop = np.asarray([end], encoder.dtype).tobytes()
        width = np.dtype(encoder.dtype).itemsize
        lengths, ids = [np.zeros(1, "<i8")], []
        with publish(f"{folder}/part-{part:05d}.bin") as out:
            for piece in by_size(batches):
                encoded = encoder.encode(texts(piece.column(1)))
                for e in encoded:
                    out.write(e)
                    out.write(stop)
                lengths.append(np.asarray([len(e) // width + 1 for e in encoded], "<i8"))
                ids.append(np.asarray(piece.column(0).fill_null(NULL_ID), "<i8"))
        offsets = np.cumsum(np.concatenate(lengths), dtype="<i8")
        with publish(f"{folder}/part-{part:05d}.off") as out:
            out.write(offsets.tobytes())
        with publish(f"{folder}/part-{part:05d}.doc") as out:
            out.write(np.concatenate([np.empty(0, "<i8"), *ids]).tobytes())
        yield pa.record_batch({"part": pa.array([part], pa.int64()), "documents": pa.array([len(offsets) - 1], pa.int64()), "tokens": pa.array([int(offsets[-1])], pa.int64())})

    return run


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end: int, id_column: str = "doc_id", text: str = "text",
    parts: int | None = None, split: bool = True,
) -> DataFrame:
    """Encode, write and return the manifest. `split=False` gives whole texts to a tokenizer of another kind."""
    spark = docs.sparkSession
    ship_package(spark)
    if parts is None:
        size = docs.agg(F.sum(F.octet_length(col(text).cast("string")))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(size / PART_BYTES))
    tie = fresh("tie", [id_column, text])
    dealt = docs.select(col(id_column).cast("long"), F.coalesce(col(text).cast("string"), F.lit("")).alias(text)).withColumn(tie, F.xxhash64(col(text)))
    dealt = dealt.repartitionByRange(parts, col(id_column), col(tie)).sortWithinPartitions(col(id_column), col(tie)).drop(tie)
    written = dealt.mapInArrow(_write_part(folder, tokenizer, end, split), "part long, documents long, tokens long")
    written.write.parquet(f"{folder}/written")
    # one row for each file; those of empty ranges hold no documents
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.schema("part long, documents long, tokens long").parquet(f"{folder}/written")
    manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).write.parquet(f"{folder}/manifest")
    return spark.read.schema("part long, documents long, tokens long, base long").parquet(f"{folder}/manifest")


def read_documents(spark: SparkSession, folder: str, vocabulary: int, id_column: str = "doc_id", ids: bool = False) -> DataFrame:
    """One row per document from the files: id, `start`, `n_tokens`, `ids_crc32` (as 32-bit ids) and, if asked for, `ids`."""
    ship_package(spark)
    dtype = id_type(vocabulary)

    def run(batches):
        for batch in batches:
            for part, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                flat = open_array(f"{folder}/part-{part:05d}.bin", dtype)
                offsets = open_array(f"{folder}/part-{part:05d}.off", "<i8")
                names = open_array(f"{folder}/part-{part:05d}.doc", "<i8")
                for at in range(0, len(names), 4096):
                    stops = offsets[at : at + 4097]
                    name = np.array(names[at : at + 4096])
                    each = [np.asarray(flat[a:b]).astype("<u4") for a, b in zip(stops, stops[1:])]
                    columns = {
                        id_column: pa.array(name, mask=name == NULL_ID), "start": pa.array(base + np.array(stops[:-1])), "n_tokens": pa.array(np.diff(stops)),
                        "ids_crc32": pa.array([zlib.crc32(x) for x in each], pa.int64()),
                    }
                    if ids:
                        columns["ids"] = pa.array([x.astype("i8") for x in each], pa.list_(pa.int64()))
                    yield pa.record_batch(columns)

    manifest = spark.read.schema("part long, documents long, tokens long, base long").parquet(f"{folder}/manifest").where("documents > 0").select("part", "base")
    files = max(1, manifest.count())
    schema = f"`{id_column}` long, start long, n_tokens long, ids_crc32 long" + ", ids array<bigint>" * ids
    return manifest.repartitionByRange(files, "part").mapInArrow(run, schema)
