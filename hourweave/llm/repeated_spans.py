"""Removal of repeated byte strings: suffixes in buckets that are refined by the buckets of later offsets.

A byte is removed if a string of `LENGTH` = 50 bytes that covers it also starts in a document with a smaller id. Only the
buckets of the suffix array at that depth matter, not the order between them.

1. Documents are dealt by a hash of id and text into slices of about `SLICE_BYTES`. Each window of 50 bytes has one anchor,
   its least 26-gram, which depends on the window alone: equal windows have equal anchors at equal offsets. Windows with
   one anchor are neighbours; together they are the anchor's context, 50 to 74 bytes.
2. The 26-gram names the initial bucket. It is refined by the names at later offsets (where the context starts, and 24
   bytes before it ends, which with the first cover it whole). Names of 26 bytes are built from names of 16 and 8.
   A slice sends each (bucket, context) once, with its smallest id, so copies within a slice are one entry; a task per
   group of buckets finds the smallest id of each context. Contexts that stand in a document with a smaller id are
   removed whole.
3. What is left are buckets with different contexts: edges of repeated passages. The first document of each different
   context sends its bytes. There suffixes are put in buckets of 8 bytes, which are refined by sorting on the buckets of
   later offsets: 8 to 16, 16 to 32, 32 to 50 bytes, each level reusing the updated one before, and suffixes that are
   alone in their bucket, or meet one id only, are left out of the next level. This compares bytes, not hashes.
4. Marks go back to the slices, where spans are merged and what is kept is hashed.

Texts are shuffled once; the three passes over them read the same exchange. An anchor with more than `CONTEXTS` different
contexts in a slice is hot: it sends one entry, and its windows go to the third step one by one, dealt by their own name.
Names of contexts have 80 bits and those that number the buckets, so equal names of different contexts need more than 2^40 of them.

Defined results: a null text is empty. A document without an id removes nothing and loses nothing. Rows with one id do not
remove each other's bytes. An empty table gives no rows. Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourweave.llm.common import col, ship_package

LENGTH = 50
GRAM = 26
SLICE_BYTES = 4 << 20
#: Bytes of entries a group of buckets should have.
BUCKET_BYTES = 2 << 20
CONTEXTS = 64
#: Windows looked at together, so that their names stay in a core's cache; their places fit into 20 bits.
BLOCK = 1 << 18

_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_U = np.uint64
COVERED, DIFFERS, HOT = 1, 2, 3


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(29))
    x *= _K[2]
    x ^= x >> _U(32)
    return x


def _words(data: np.ndarray, start: int, n: int) -> np.ndarray:
    """The 8 bytes at each of `n` places."""
    return np.ndarray((n,), "<u8", data, start, (1,)).copy()


def _names(data: np.ndarray, start: int, n: int) -> np.ndarray:
    """Names of the 26-grams at `n` places: two names of 16 bytes that overlap, each from two words."""
    words = _words(data, start, n + 18)
    pairs = _mix(words[: n + 10] * _K[0] + words[8 : n + 18] * _K[1])
    return _mix(pairs[:n] * _K[3] + pairs[10 : n + 10] * _K[4])


def _names_at(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    every = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    a, b, c, d = (every[places + i] for i in (0, 8, 10, 18))
    return _mix(_mix(a * _K[0] + b * _K[1]) * _K[3] + _mix(c * _K[0] + d * _K[1]) * _K[4])


class Slice:
    """Documents of a slice, those with an id and 50 bytes in one array, and the anchors of their windows."""

    def __init__(self, table: pa.Table) -> None:
        rows = zip(table.column("key").to_pylist(), table.column("bytes").to_pylist())
        self.rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        self.long = [i for i, (key, text) in enumerate(self.rows) if key is not None and len(text) >= LENGTH]
        self.ids = np.array([self.rows[i][0] for i in self.long], np.int64)
        sizes = np.array([len(self.rows[i][1]) for i in self.long], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.data = np.frombuffer(b"".join(self.rows[i][1] for i in self.long) + bytes(64), np.uint8)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last window start and the anchor's place, for each run of windows with one anchor."""
        first, last, place = [], [], []
        for begin, end in zip(self.starts[:-1], self.starts[1:] - LENGTH + 1):
            first.append(np.arange(begin, end, BLOCK))
            last.append(np.minimum(first[-1] + BLOCK, end))
        blocks = list(zip(np.concatenate(first), np.concatenate(last))) if first else []
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        i = 0
        while i < len(blocks):  # neighbouring short documents share a pass
            j, begin = i + 1, int(blocks[i][0])
            while j < len(blocks) and blocks[j][1] - begin <= BLOCK:
                j += 1
            n = int(blocks[j - 1][1]) - begin
            least = _names(self.data, begin, n + LENGTH - GRAM) & ~_U(0xFFFFF) | np.arange(n + LENGTH - GRAM, dtype=np.uint64)
            width = 1
            while 2 * width <= LENGTH - GRAM + 1:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if rest := LENGTH - GRAM + 1 - width:
                least = np.minimum(least[:-rest], least[rest:])
            at = (least & _U(0xFFFFF)).astype(np.int64)
            change = np.flatnonzero(at[1:] != at[:-1]) + 1
            # runs also end where a document's windows end; those between documents are left out
            opens = np.array([b - begin for b, _ in blocks[i:j]], np.int64)
            ends = np.array([e - begin for _, e in blocks[i:j]], np.int64)
            cuts = np.unique(np.concatenate([change, opens, ends]))
            left, right = cuts[:-1], cuts[1:]
            inside = np.searchsorted(opens, left, "right") - 1
            keep = left < ends[inside]
            left, right = left[keep], right[keep]
            found.append((left + begin, right - 1 + begin, at[left] + begin))
            i = j
        if not found:
            return (np.empty(0, np.int64),) * 3
        first, last, place = (np.concatenate(x) for x in zip(*found))
        # a long document's blocks meet inside a run
        joined = np.concatenate([[False], (place[1:] == place[:-1]) & (first[1:] == last[:-1] + 1)])
        return first[~joined], last[np.concatenate([~joined[1:], [True]])], place[~joined]

    def entries(self, buckets: int, contexts: int) -> Entries:
        return Entries(self, buckets, contexts)


class Entries:
    """What a slice sends of its contexts, in an order that depends on the texts only."""

    def __init__(self, own: Slice, buckets: int, contexts: int) -> None:
        self.first, self.last, place = own.anchors()
        gram = _names_at(own.data, place)
        begin, middle, end = (_names_at(own.data, x) for x in (self.first, self.first + LENGTH - GRAM, self.last + LENGTH - GRAM))
        shape = ((place - self.first) * 64 + (self.last - self.first)).astype(np.uint64)
        context = _mix(_mix(begin * _K[0] + middle * _K[1]) + end * _K[4] + gram * _K[2] + shape * _K[3]) >> _U(16)
        self.doc = np.searchsorted(own.starts, self.first, "right") - 1
        ids = own.ids[self.doc]
        bucket = ((gram >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
        short = (gram & _U(0xFFFFFFFF)).astype(np.int64)
        order = np.lexsort((ids, context, short, bucket))
        b, g, c, d = bucket[order], short[order], context[order], ids[order]
        new_gram = np.concatenate([[True], (b[1:] != b[:-1]) | (g[1:] != g[:-1])])[: len(b)]
        new = new_gram | np.concatenate([[True], c[1:] != c[:-1]])[: len(b)]
        # each run's context, and the smallest id of that context here
        nth = np.cumsum(new) - 1
        self.least_of_context = d[new]
        self.context = np.empty(len(b), np.int64)
        self.context[order] = nth
        gram_of = (np.cumsum(new_gram) - 1)[new]
        hot = np.bincount(gram_of, minlength=1)[gram_of] > contexts if len(gram_of) else np.empty(0, bool)
        first_of_gram = new_gram[new]
        sent = ~hot | first_of_gram
        # a hot anchor's entry has context 0 and the smallest id of all
        least = self.least_of_context.copy()
        if hot.any():
            smallest = np.minimum.reduceat(self.least_of_context, np.flatnonzero(first_of_gram))
            least[hot] = smallest[gram_of[hot]]
        self.entry_of_context = (np.cumsum(sent) - 1)
        keep = sent.nonzero()[0]
        self.bucket, self.gram = b[new][keep], g[new][keep]
        self.name = np.where(hot[keep], 0, c[new][keep].astype(np.int64) | 1)
        self.least = least[keep]

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, packed entries); bytes of equal weight stand together, as they compress."""
        cuts = np.flatnonzero(np.diff(self.bucket)) + 1
        for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(self.bucket)]])):
            if b > a:
                yield int(self.bucket[a]), _pack(self.gram[a:b], 4) + _pack(self.name[a:b], 6) + _pack(self.least[a:b], 8)


def _pack(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpack(blob: bytes, width: int, n: int, start: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8, width * n, start).reshape(width, n).T
    return out.view("<i8").ravel()


def refine_buckets(blobs: list[bytes]) -> list[bytes]:
    """A mark for each packed entry of one group of buckets."""
    counts = [len(x) // 18 for x in blobs]
    gram, name, least = (np.concatenate([_unpack(x, w, n, n * at) for x, n in zip(blobs, counts)]) for w, at in ((4, 0), (6, 4), (8, 10)))
    order = np.lexsort((least, name, gram))
    g, c, d = gram[order], name[order], least[order]
    new_gram = np.concatenate([[True], g[1:] != g[:-1]])
    new = new_gram | np.concatenate([[True], c[1:] != c[:-1]])
    starts = np.flatnonzero(new_gram)
    of_gram = np.cumsum(new_gram) - 1
    several = (np.add.reduceat(new.astype(np.int64), starts) > 1) & (np.minimum.reduceat(d, starts) < np.maximum.reduceat(d, starts))
    hot = np.logical_or.reduceat(c == 0, starts)
    smallest = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    marks = np.zeros(len(g), np.uint8)
    marks[several[of_gram]] = DIFFERS
    marks[d > smallest] = COVERED
    marks[hot[of_gram]] = HOT
    back = np.empty(len(g), np.uint8)
    back[order] = marks
    return [x.tobytes() for x in np.split(back, np.cumsum(counts)[:-1])]


def repeated_windows(data: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of the windows that start at `starts` in `data`, those whose bytes also start under a smaller id.

    Bucket pointers by doubling: 8 bytes are a number; two pointers of a level are the next one.
    """
    open_ = np.arange(len(starts))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    pointer = np.ndarray((len(data),), "<u8", padded, 0, (1,)).copy()
    depth = 8
    for step, later in ((8, (0, 16, 18, 34)), (16, (0, 18)), (18, (0,))):
        # places whose pointers the open windows still need at the new depth
        need = np.zeros(len(data), bool)
        for offset in later:
            need[starts[open_] + offset] = True
        places = np.flatnonzero(need)
        pair = np.stack([pointer[places], pointer[places + step]], axis=1)
        order = np.lexsort((pair[:, 1], pair[:, 0]))
        pair = pair[order]
        new = np.concatenate([[False], (pair[1:] != pair[:-1]).any(axis=1)])[: len(pair)]
        pointer = np.zeros(len(data), np.uint64)
        pointer[places[order]] = np.cumsum(new).astype(np.uint64)
        depth += step
        # windows whose bucket has one id are settled
        bucket = pointer[starts[open_]].astype(np.int64)
        if not len(bucket):
            break
        n = int(bucket.max()) + 1
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
        np.minimum.at(low, bucket, ids[open_])
        np.maximum.at(high, bucket, ids[open_])
        mixed = (low < high)[bucket]
        if depth == LENGTH:
            mixed = ids[open_] > low[bucket]
        open_ = open_[mixed]
    found = np.zeros(len(starts), bool)
    found[open_] = True
    return found


def _edges(own: Slice, buckets: int, contexts: int, marks: np.ndarray) -> tuple[dict, list[tuple[int, bytes]]]:
    """What the marks settle in a slice, and the strings that need comparing: (bucket, packed strings)."""
    e = own.entries(buckets, contexts)
    mark = marks[e.entry_of_context] if len(e.entry_of_context) else marks  # per context
    ids = own.ids[e.doc] if len(e.doc) else e.doc
    run_mark = mark[e.context]
    covered = (run_mark == COVERED) | (ids > e.least_of_context[e.context])
    ask = ~covered & (run_mark >= DIFFERS)
    # the first run of each context with its smallest id speaks for the others
    runs = np.flatnonzero(ask)
    _, where, place = np.unique(e.context[runs], return_index=True, return_inverse=True)
    heads = runs[where]
    strings: dict[int, list[tuple[int, int, int, int]]] = {}
    for k, run in enumerate(heads.tolist()):
        a, b, key = int(e.first[run]), int(e.last[run]), int(ids[run])
        if run_mark[run] == DIFFERS:
            strings.setdefault(int(e.bucket[e.entry_of_context[e.context[run]]]), []).append((k, a, b, key))
        else:
            names = _mix(_names_at(own.data, np.arange(a, b + 1)) * _K[0] + _names_at(own.data, np.arange(a, b + 1) + LENGTH - GRAM))
            for o, name in zip(range(a, b + 1), ((names >> _U(32)) * _U(buckets) >> _U(32)).tolist()):
                strings.setdefault(buckets + int(name), []).append((k, o, o, key))
    sent, out = [], []
    for bucket in sorted(strings):
        rows = strings[bucket]
        sent += [(k, a) for k, a, _, _ in rows]
        sizes = np.array([b - a + LENGTH for _, a, b, _ in rows], np.uint8)
        body = b"".join(own.data[a : b + LENGTH].tobytes() for _, a, b, _ in rows)
        out.append((bucket, len(rows).to_bytes(8, "little") + sizes.tobytes() + _pack(np.array([r[3] for r in rows], np.int64), 8) + body))
    head_first = e.first[heads] if len(heads) else heads
    told = {
        "first": e.first[covered].astype(np.int64), "last": e.last[covered].astype(np.int64),
        "head": np.array([k for k, _ in sent], np.int64), "shift": np.array([a - int(head_first[k]) for k, a in sent], np.int64),
        "run": e.first[runs].astype(np.int64), "of": place.ravel().astype(np.int64),
    }
    return told, out


def compare_strings(blobs: list[bytes]) -> list[bytes]:
    """For each packed string a number whose bit i says that the window at i is repeated."""
    data, starts, ids, owner, counts = [], [], [], [], []
    at = 0
    for blob in blobs:
        n = int.from_bytes(blob[:8], "little")
        sizes = np.frombuffer(blob, np.uint8, n, 8).astype(np.int64)
        keys = _unpack(blob, 8, n, 8 + n)
        data.append(np.frombuffer(blob, np.uint8, -1, 8 + 9 * n))
        begins = at + np.cumsum(sizes) - sizes
        windows = sizes - LENGTH + 1
        which = np.repeat(np.arange(n), windows)
        starts.append(begins[which] + np.arange(len(which)) - (np.cumsum(windows) - windows)[which])
        ids.append(keys[which])
        owner.append(which + sum(counts))
        counts.append(n)
        at += int(sizes.sum())
    start, own = np.concatenate(starts), np.concatenate(owner)
    found = repeated_windows(np.concatenate(data), start, np.concatenate(ids))
    first = np.concatenate([[True], own[1:] != own[:-1]])
    bit = start - start[np.flatnonzero(first)][np.cumsum(first) - 1]
    masks = np.zeros(sum(counts), np.uint32)
    np.bitwise_or.at(masks, own[found], (1 << bit[found]).astype(np.uint32))
    return [x.tobytes() for x in np.split(masks, np.cumsum(counts)[:-1])]


def _spans(told: dict, masks: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merged removed ranges of a slice's array; none goes over the end of a document."""
    begin, end = [told["first"]], [told["last"] + LENGTH]
    # windows of a head, then of every run with its context
    per_head = np.zeros(int(told["of"].max()) + 1 if len(told["of"]) else 0, np.uint32)
    np.bitwise_or.at(per_head, told["head"], masks << told["shift"].astype(np.uint32))
    of_run = per_head[told["of"]]
    for bit in range(LENGTH - GRAM + 1):
        hit = told["run"][(of_run >> np.uint32(bit)) & np.uint32(1) == 1] + bit
        begin.append(hit)
        end.append(hit + LENGTH)
    begin, end = np.concatenate(begin), np.concatenate(end)
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], end[order]
    if not len(begin):
        return begin, end
    reach = np.maximum.accumulate(end)
    doc = np.searchsorted(starts, begin, "right")
    new = np.concatenate([[True], (begin[1:] > reach[:-1]) | (doc[1:] != doc[:-1])])
    return begin[new], reach[np.concatenate([new[1:], [True]])]


_TOLD = -1


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", slice_bytes: int = SLICE_BYTES, bucket_bytes: int = BUCKET_BYTES,
    contexts: int = CONTEXTS,
) -> DataFrame:
    """Per row: id, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`."""
    ship_package(docs.sparkSession)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(col(id_column).cast("long").alias("key"), F.coalesce(col(text).cast("string").cast("binary"), F.lit(b"")).alias("bytes"))
    total = rows.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    slices = max(1, ceil(total / slice_bytes))
    # an entry of 18 bytes for each 13 of text, less what compresses
    buckets = max(1, ceil(total / bucket_bytes))
    dealt = rows.withColumn("slice", F.pmod(F.xxhash64("key", "bytes"), F.lit(slices)).cast("int")).repartition(parts, "slice")
    blob_schema = pa.schema([("slice", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary())])
    blob_ddl = "slice int, bucket int, blob binary"

    def table(found: list[tuple[int, int, bytes]]) -> pa.Table:
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, blob_schema.types)], schema=blob_schema)

    def in_order(found: pa.Table) -> list[tuple[int, int, bytes]]:
        """Rows (slice, bucket, blob) of a task, always in one order."""
        return sorted(zip(*(found.column(c).to_pylist() for c in ("slice", "bucket", "blob"))))

    def send(key: tuple, left: pa.Table) -> pa.Table:
        number = key[0].as_py()
        return table([(number, b, blob) for b, blob in Slice(left).entries(buckets, contexts).rows()])

    def refine(key: tuple, found: pa.Table) -> pa.Table:
        got = in_order(found)
        return table([(s, b, marks) for (s, b, _), marks in zip(got, refine_buckets([x[2] for x in got]))])

    def edges(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return table([])
        number = left.column("slice")[0].as_py()
        own = Slice(left)
        marks = np.frombuffer(b"".join(x[2] for x in in_order(right)), np.uint8)
        told, strings = _edges(own, buckets, contexts, marks)
        return table([(number, -1 - number, pickle.dumps(told)), *[(number, b, blob) for b, blob in strings]])

    def compare(key: tuple, found: pa.Table) -> pa.Table:
        got = in_order(found)
        if got[0][1] < 0:  # a slice's own notes go on as they are
            return table(got)
        return table([(s, b, masks) for (s, b, _), masks in zip(got, compare_strings([x[2] for x in got]))])

    result = pa.schema([(id_column, pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def cut(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        own = Slice(left)
        begin = end = np.empty(0, np.int64)
        got = in_order(right)
        if got:
            told = pickle.loads(got[0][2])
            begin, end = _spans(told, np.frombuffer(b"".join(x[2] for x in got[1:]), np.uint32), own.starts)
        spans: dict[int, list[tuple[int, int]]] = {}
        for doc, a, b in zip((np.searchsorted(own.starts, begin, "right") - 1).tolist(), begin.tolist(), end.tolist()):
            spans.setdefault(own.long[doc], []).append((a - int(own.starts[doc]), b - int(own.starts[doc])))
        out = []
        for i, (number, value) in enumerate(own.rows):
            digest, at, removed = hashlib.sha256(), 0, 0
            view = memoryview(value)
            for a, b in spans.get(i, ()):
                digest.update(view[at:a])
                at, removed = b, removed + b - a
            digest.update(view[at:])
            out.append((number, len(value), removed, len(spans.get(i, ())), digest.hexdigest()))
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 5, result.types)], schema=result)

    entries = dealt.groupBy("slice").applyInArrow(send, blob_ddl)
    marks = entries.groupBy("bucket").applyInArrow(refine, blob_ddl)
    strings = dealt.groupBy("slice").cogroup(marks.repartition(parts, "slice").groupBy("slice")).applyInArrow(edges, blob_ddl)
    compared = strings.groupBy("bucket").applyInArrow(compare, blob_ddl)
    last = dealt.groupBy("slice").cogroup(compared.repartition(parts, "slice").groupBy("slice"))
    return last.applyInArrow(cut, f"`{id_column}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
