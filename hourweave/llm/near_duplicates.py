"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and union-find.

1. One pass over the texts gives each document its set of 5-word shingles (64-bit hashes), a 128-bit digest of that
   set and its SuperMinHash signature as band keys of up to 5 registers and one byte of each register. Documents with
   equal sets are one class; only classes go on, so copies cost one aggregation.
2. Classes that share a band key are a bucket. The number of bands follows from the threshold (`banding`: 25 of 5 at
   0.85, 37 of 5 at 0.8), so that a pair at it misses all bands with a probability of at most 5e-7. Buckets are not
   turned into pairs: each class is compared with its bucket's smallest one, and found links are merged into
   components. Only buckets that still hold several components go on.
3. Buckets that share classes form a cluster. A cluster of up to `CLUSTER_MOST` classes is cut into blocks; a task takes
   two blocks of whole sets, gets all their intersections as one matrix product and returns links that join components,
   fewer than it has classes. In buckets of larger clusters, members outside the component that is largest before the
   first round are compared with those of other components, 32 leaders a bucket, then 1024, and so on, until every pair
   of a bucket is in one component or was compared: each such member leads once, whatever becomes the largest component
   later. No pair is dropped either way.
   Such a comparison first looks at sizes and the register bytes (a pair at the threshold falls below `least_alike`
   with a probability of at most 1e-9), then intersects the whole sets.
4. Links are merged inside each task by union-find, then across tasks by contracting to the smallest neighbour, until
   no link between two components is left.

Defined results: texts without a word have the empty set and stay alone; with fewer words than a shingle, the sequence
is the one shingle; null ids are linked with nothing, have no component and are kept; repeated rows share a component,
and all rows of the kept id are marked kept (`deduplicate` keeps one of them); an id with several texts is judged text by
text: its rows may be in several groups, of which two can bear its id, and `deduplicate` keeps one row of each group;
an empty table gives none; only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourweave.llm.common import col, fresh, release_memory, ship_package, slices, texts
from hourweave.session import materialise

WIDTH = 5
REGISTERS, BAND_ROWS = 125, 5
#: The threshold of group_duplicates, and the one at which deduplicate removes.
PERCENT = 85
REMOVE_PERCENT = 80
#: Probabilities that a pair at the threshold shares no band, and that its register bytes look less alike.
MISSED_BANDS, MISSED_BYTES = 5e-7, 1e-9
#: Bands before their registers become fewer.
BANDS_MOST = 64
#: Remembered words of a worker, the first it meets; frequent ones are among them.
CACHE = 50_000
#: Ids sent to all tasks at once, 16 MB; more of them are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Links that one task may unite, some 100 MB.
LOCAL_LINKS = 300_000
#: Leaders of a mixed bucket in the first round, and the factor for each further one.
LEADERS = 32
#: Classes of a cluster that is compared in blocks, and the classes and set elements of a block.
CLUSTER_MOST = 50_000
BLOCK_CLASSES, BLOCK_ELEMENTS = 1024, 500_000
#: Classes of two blocks after which a worker gives freed memory back.
RELEASE_CLASSES = 256

_words: dict[bytes, bytes] = {}
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def banding(percent: int) -> tuple[int, int]:
    """Bands and registers a band for pairs that are alike by `percent` or more."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent has to be over 0 and at most 100: {percent}")
    for rows in range(BAND_ROWS, 0, -1):
        hit = (percent / 100) ** rows
        bands = max(1, math.ceil(math.log(MISSED_BANDS) / math.log1p(-hit))) if hit < 1 else 1
        if bands <= BANDS_MOST:
            break
    return bands, rows


def least_alike(percent: int) -> float:
    """The share of register bytes below which a pair is not verified."""
    registers = math.prod(banding(percent))
    share, below, k = percent / 100, 0.0, 0
    while k < registers:
        below += math.comb(registers, k) * share**k * (1 - share) ** (registers - k)
        if below > MISSED_BYTES:
            break
        k += 1
    return k / registers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word(word: bytes) -> bytes:
    found = xxhash.xxh3_64_intdigest(word).to_bytes(8, "little")
    if len(_words) < CACHE:
        _words[word] = found
    return found


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word windows; A-Z are lower-cased, words are split at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # on bytes, both mean exactly that
    if not words:
        return np.empty(0, np.uint64)
    known = _words.get
    h = np.frombuffer(b"".join([known(w) or _word(w) for w in words]), "<u8")
    n = min(width, len(h))
    total = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        total += _mix(h[k : len(h) - n + 1 + k] * _MULTIPLIERS[k % 5] + np.uint64(k + 1))
    return np.unique(_mix(total + np.uint64(n)))


def signature(elements: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """SuperMinHash: in round j every element draws a value in [j, j + 1) for the j-th place of its own random order of the
    registers; a register keeps the smallest. Values of a round cannot beat those of an earlier one, so rounds end once
    every register is filled. 40 fraction bits."""
    sig = np.full(registers, np.iinfo(np.int64).max, np.int64)
    order = None
    rows = np.arange(len(elements))
    for j in range(registers):
        draw = _mix(elements + np.uint64((j + 1) * 0xD1B54A32D192ED03 % (1 << 64)))
        pick = (j + ((draw & np.uint64(0xFFFFFF)) * np.uint64(registers - j) >> np.uint64(24)).astype(np.int64))
        value = (draw >> np.uint64(24)).astype(np.int64) + (j << 40)
        if j == 0:
            place = pick
            first = pick
        else:
            if order is None:
                order = np.tile(np.arange(registers, dtype=np.int16), (len(elements), 1))
                order[rows, 0], order[rows, first] = first, 0
            place = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[rows, j]
            order[rows, j] = place
        np.minimum.at(sig, place, value)
        if sig.max() < (j + 1) << 40:
            break
    return sig


def band_keys(sig: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    parts = sig.astype(np.uint64).reshape(-1, rows)
    key = np.arange(1, len(parts) + 1, dtype=np.uint64)
    for k in range(rows):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return key.view(np.int64)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, id_column: str, text: str, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """`id, n, node, bands, bytes` of every row; `node` names the shingle set."""
    registers, band_rows = math.prod(banding(percent)), banding(percent)[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sizes, nodes, bands, low = [], [], [], []
            for value in texts(part.column(1)):
                s = shingles(value, width)
                sizes.append(len(s))
                if len(s):
                    sig = signature(s, registers)
                    nodes.append(_digest(s))
                    bands.append(band_keys(sig, band_rows))
                    low.append((sig & 255).astype(np.uint8).tobytes())
                else:
                    nodes.append(None)
                    bands.append(None)
                    low.append(None)
            yield pa.record_batch({
                "id": part.column(0), "n": pa.array(sizes, pa.int64()), "node": pa.array(nodes, pa.binary()),
                "bands": pa.array(bands, pa.list_(pa.int64())), "bytes": pa.array(low, pa.binary()),
            })
        release_memory()

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(col(id_column), col(text).cast("string")).mapInArrow(run, f"id {kind}, n long, node binary, bands array<bigint>, bytes binary")


def _sets(docs: DataFrame, id_column: str, text: str, wanted: DataFrame, width: int) -> DataFrame:
    """`node, set` of the wanted (id, node) rows: their texts are read again."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [(node, s) for value, node in zip(texts(part.column(0)), part.column(1).to_pylist()) if _digest(s := shingles(value, width)) == node]
            yield pa.record_batch({
                "node": pa.array([node for node, _ in found], pa.binary()), "set": pa.array([s.view(np.int64) for _, s in found], pa.list_(pa.int64()))})
        release_memory()

    wanted = wanted.select(F.col("id").alias("wanted"), "node")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    rows = docs.select(col(id_column).alias("id"), col(text).cast("string").alias("text")).join(wanted, F.col("id") == F.col("wanted"))
    # rows that repeat an id may give a set twice
    return rows.select("text", "node").mapInArrow(run, "node binary, set array<bigint>").groupBy("node").agg(F.first("set").alias("set"))


def _alike(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs whose register bytes agree on a share of `least` or more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 8192):
            if part.num_rows:
                x, y = (np.frombuffer(b"".join(part.column(k).to_pylist()), np.uint8).reshape(part.num_rows, -1) for k in (2, 3))
                yield part.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    return pairs.select("a", "b", "bytes_a", "bytes_b").mapInArrow(run, "a binary, b binary")


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_column: str, text: str, width: int, percent: int) -> DataFrame:
    """The distinct pairs (a, b) of classes with 100 * |a and b| >= percent * |a or b|, stored."""
    info = classes.select("node", "n", "bytes")
    a, b = (info.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("bytes").alias(f"bytes_{k}")) for k in "ab")
    sized = pairs.distinct().join(b, "b").join(a, "a").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    likely = materialise(_alike(sized, least_alike(percent)), "likely-pairs")
    nodes = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    sets = materialise(_sets(docs, id_column, text, classes.select("id", "node").join(nodes, "node", "left_semi"), width), "sets")
    with_sets = likely.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
    with_sets = with_sets.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    linked = with_sets.select("a", "b", common.alias("c"), (F.size("set_a") + F.size("set_b") - common).alias("u"))
    return materialise(linked.where(100 * F.col("c") >= percent * F.col("u")).select("a", "b"), "links")


def _local_union(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one task's links: each node but the smallest of its local component, with that one."""
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    found = [(x, root(x)) for x in list(parent)]
    found = [(x, r) for x, r in found if x != r]
    for i in range(0, len(found), 50_000):
        piece = found[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(column, pa.binary()) for column in zip(*piece)], names=["a", "b"])


def components(links: DataFrame, together: int = LOCAL_LINKS) -> DataFrame:
    """`node, component` for nodes of links (a, b), stored; the component is its smallest node, which may be left out.

    Up to `together` links go through one task's union-find; more are united per task and contracted across tasks.
    """
    if links.count() <= together:
        return materialise(links.coalesce(1).mapInArrow(_local_union, "a binary, b binary").toDF("node", "component"), "components")
    edges = materialise(links.select("a", "b").mapInArrow(_local_union, "a binary, b binary").distinct(), "links-local")
    members = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    known = members.withColumn("component", F.col("node"))
    while True:
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        parent = both.groupBy("a").agg(F.min("b").alias("b")).withColumn("b", F.least("a", "b"))
        jumped = parent.alias("p").join(parent.select(F.col("a").alias("via"), F.col("b").alias("to")), F.col("b") == F.col("via"))
        jumped = materialise(jumped.select("a", F.col("to").alias("b")), "parents")
        known = materialise(
            known.join(jumped.select(F.col("a").alias("component"), "b"), "component", "left").select("node", F.coalesce("b", "component").alias("component")), "components")
        above, below = jumped.toDF("a", "to_a"), jumped.toDF("b", "to_b")
        left = edges.join(above, "a").join(below, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).where("a <> b")
        edges = materialise(left.mapInArrow(_local_union, "a binary, b binary").distinct(), "links-left")
        if edges.isEmpty():
            return known


def _buckets(classes: DataFrame) -> DataFrame:
    """`key, node, leader` for keys with several classes, stored; the leader is the smallest class of the bucket."""
    banded = classes.select(F.explode("bands").alias("key"), "node")
    heads = banded.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("size")).where("size > 1").drop("size")
    return materialise(banded.join(heads, "key"), "buckets")


def _exempt(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """`key, node, size, exempt`, stored: members of the bucket's largest component never lead."""
    named = buckets.select("key", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    each = named.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = each.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.sum("n").alias("size"))
    return materialise(named.join(largest, "key").select("key", "node", "size", (F.col("component") == F.col("largest")).alias("exempt")), "buckets-exempt")


def _open_pairs(buckets: DataFrame, found: DataFrame, start: int, end: int) -> tuple[DataFrame, DataFrame]:
    """Members of buckets with several components, stored, and the pairs of their leaders number `start` to `end`.

    A bucket's members that are not exempt lead in the order of a hash: member x leads if the hash, as a share of its
    range, falls into [start / size, end / size).
    """
    named = buckets.select("key", "node", "size", "exempt").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = named.groupBy("key").agg((F.min("component") != F.max("component")).alias("mixed")).where("mixed").select("key")
    mixed = materialise(named.join(several, "key"), "mixed-buckets")
    place = F.pmod(F.xxhash64("key", "node"), F.lit(1 << 30)) * F.col("size") / (1 << 30)
    leads = ~F.col("exempt") & (place >= start) & (place < end)
    leaders = mixed.where(leads).select("key", F.col("node").alias("l"), F.col("component").alias("lc"))
    pairs = mixed.join(leaders, "key").where(F.col("component") != F.col("lc"))
    return mixed, pairs.select(F.least("l", "node").alias("a"), F.greatest("l", "node").alias("b"))


def compare_leaders(buckets: DataFrame, links: DataFrame, found: DataFrame, compare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`node, component` once every pair of a bucket is in one component or was compared; `compare` gives the links of pairs."""
    start, end = 0, LEADERS
    if not buckets.isEmpty():
        buckets = _exempt(buckets, found)
    while not buckets.isEmpty():
        buckets, pairs = _open_pairs(buckets, found, start, end)
        if buckets.isEmpty():
            break
        largest = buckets.agg(F.max("size")).first()[0]
        more = compare(pairs)
        if not more.isEmpty():
            links = links.unionByName(more)
            found = components(links)
        if end >= largest:
            break
        start, end = end, end * LEADERS
    return found


def _open_clusters(buckets: DataFrame, found: DataFrame, classes: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Classes of clusters of buckets with several components: `cluster, node, component, id, n, blocks`, stored; and the
    buckets (`key, node`) of larger clusters."""
    named = buckets.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = named.groupBy("key").agg((F.min("component") != F.max("component")).alias("mixed")).where("mixed").select("key")
    mixed = materialise(named.join(several, "key"), "mixed-buckets")
    joined = components(mixed.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct())
    members = mixed.select("node", "component").distinct().join(joined.withColumnRenamed("component", "cluster"), "node", "left")
    members = materialise(members.withColumn("cluster", F.coalesce("cluster", "node")).join(classes.select("node", "id", "n"), "node"), "clusters")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("n").alias("elements"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK_CLASSES), F.ceil(F.col("elements") / BLOCK_ELEMENTS), F.lit(1))
    members = materialise(members.join(sizes, "cluster").withColumn("blocks", blocks), "clusters-sized")
    large = members.where(F.col("size") > most).select("node")
    return members.where(F.col("size") <= most), mixed.select("key", "node").join(large, "node", "left_semi")


def _compare_blocks(percent: int):
    def run(key, table):
        found = links(key, table)
        if table.num_rows > RELEASE_CLASSES:
            release_memory()
        return found

    def links(key, table):
        table = table.sort_by("node")
        nodes, parts = table["node"].to_pylist(), table["component"].to_pylist()
        names = {c: k for k, c in enumerate(dict.fromkeys(parts))}
        part = np.array([names[c] for c in parts])
        block = np.asarray(table["block"])
        own = table["set"].combine_chunks()
        sizes = np.diff(np.asarray(own.offsets))
        row = np.repeat(np.arange(len(nodes)), sizes)
        _, element, often = np.unique(np.asarray(own.flatten()), return_inverse=True, return_counts=True)
        # an element of one set only is in no intersection
        rank = np.cumsum(often > 1) - 1
        shared = often[element] > 1
        row, element = row[shared], rank[element[shared]]
        order = np.argsort(element, kind="stable")
        row, element = row[order], element[order]
        left, right = np.flatnonzero(block == key[1].as_py()), np.flatnonzero(block == key[2].as_py())
        common = np.zeros((len(left), len(right)), np.float32)
        width = 4096
        for start in range(0, int(rank[-1]) + 1 if len(rank) else 0, width):
            a, b = np.searchsorted(element, [start, start + width])
            chunk = np.zeros((len(nodes), width), np.float32)
            chunk[row[a:b], element[a:b] - start] = 1
            common += chunk[left] @ chunk[right].T
        # counts are whole below 2^24, a hundred times them is not
        common = common.astype(np.int64)
        linked = 100 * common >= percent * (sizes[left][:, None] + sizes[right][None, :] - common)
        linked &= part[left][:, None] != part[right][None, :]
        x, y = np.nonzero(linked)
        x, y = left[x], right[y]
        label = part.copy()
        kept: list[int] = []
        while True:
            open_ = np.flatnonzero(label[x] != label[y])
            if not len(open_):
                break
            # one link of each label; every round joins each label that still has a link to another
            _, first = np.unique(label[x[open_]], return_index=True)
            for k in open_[first]:
                one, two = label[x[k]], label[y[k]]
                if one != two:
                    kept.append(k)
                    label[label == max(one, two)] = min(one, two)
        return pa.table({"a": pa.array([min(nodes[x[k]], nodes[y[k]]) for k in kept], pa.binary()), "b": pa.array([max(nodes[x[k]], nodes[y[k]]) for k in kept], pa.binary())})

    return run


def compare_clusters(members: DataFrame, docs: DataFrame, id_column: str, text: str, width: int, percent: int) -> DataFrame:
    """Links (a, b) that join the components of each cluster, stored."""
    sets = _sets(docs, id_column, text, members, width)
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    full = members.join(sets, "node").withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    full = full.select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component", "block", "set")
    return materialise(full.groupBy("cluster", "i", "j").applyInArrow(_compare_blocks(percent), "a binary, b binary"), "cluster-links")


def group_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, cluster_most: int = CLUSTER_MOST,
) -> DataFrame:
    """One row per document: id, `n_shingles`, `component_id`, `kept`."""
    return _grouped(docs, id_column, text, width, percent, cluster_most).select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.col("smallest").alias("component_id"), "kept")


def _grouped(docs: DataFrame, id_column: str, text: str, width: int, percent: int, cluster_most: int = CLUSTER_MOST) -> DataFrame:
    """One row per document: `id, n, node, component, smallest, kept`; node and component are null without words or id."""
    ship_package(docs.sparkSession)
    rows = materialise(sketches(docs, id_column, text, width, percent), "shingle-sketches")
    named = rows.where(F.col("node").isNotNull() & F.col("id").isNotNull())
    # the registers follow from the set, so any row of a class has them
    classes = materialise(named.groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("bytes").alias("bytes")), "classes")
    buckets = _buckets(classes)
    pairs = buckets.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    links = verify(pairs, classes, docs, id_column, text, width, percent)
    found = components(links)
    clustered, buckets = _open_clusters(buckets, found, classes, cluster_most)
    links = links.unionByName(compare_clusters(clustered, docs, id_column, text, width, percent))
    found = components(links)
    found = compare_leaders(buckets, links, found, lambda pairs: verify(pairs, classes, docs, id_column, text, width, percent))
    merged = classes.select("node", "id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = merged.groupBy("component").agg(F.min("id").alias("smallest"))
    of_node = merged.join(smallest, "component").select("node", "component", "smallest")
    alone = F.col("node").isNull() | F.col("id").isNull()
    joined = named.select("id", "n", "node").join(of_node, "node").select("id", "n", "node", "component", "smallest")
    none = F.lit(None).cast("binary")
    rest = rows.where(alone).select("id", "n", none.alias("node"), none.alias("component"), F.col("id").alias("smallest"))
    return joined.unionByName(rest).withColumn("kept", F.coalesce(F.col("id") == F.col("smallest"), F.lit(True)))


def _nodes_of(docs: DataFrame, text: str, name: str, width: int) -> DataFrame:
    """`docs` with the name of each row's shingle set, null without words."""
    whole = fresh("whole__text", [*docs.columns, name])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [shingles(value, width) for value in texts(part.column(part.num_columns - 1))]
            nodes = pa.array([_digest(s) if len(s) else None for s in sets], pa.binary())
            own = list(part.schema)[:-1]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], nodes], schema=pa.schema([*own, pa.field(name, pa.binary())]))

    rows = docs.select(*[col(c) for c in docs.columns], col(text).cast("string").alias(whole))
    return rows.mapInArrow(run, docs.withColumn(name, F.lit(None).cast("binary")).schema)


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = REMOVE_PERCENT) -> DataFrame:
    """The rows of `docs` less all but one of each group of near-duplicates; rows with null ids stay.

    Rows of ids that occur once are removed by id; those of repeated ids are taken by id and shingle set, one of each group.
    """
    grouped = materialise(_grouped(docs, id_column, text, width, percent).select("id", "node", "component", "kept"), "groups")
    per_id = grouped.where(F.col("id").isNotNull()).groupBy("id").agg(F.count("*").alias("n"), F.bool_and("kept").alias("kept"))
    changed = materialise(per_id.where("n > 1 OR NOT kept").select("id", "n"), "changed-ids")
    few = changed.count() <= BROADCAST_IDS
    sent = lambda ids: F.broadcast(ids) if few else ids
    key, node, component = (fresh(x, docs.columns) for x in ("changed__id", "row__node", "row__component"))
    left = docs.join(sent(changed.select(F.col("id").alias(key))), col(id_column) == col(key), "left_anti")
    repeated = changed.where("n > 1").select("id")
    if repeated.isEmpty():
        return left
    again = docs.join(sent(repeated.toDF(key)), col(id_column) == col(key), "left_semi")
    stay = grouped.where("kept").join(sent(repeated), "id", "left_semi").select(F.col("id").alias(key), F.col("node").alias(node + "_"), F.col("component").alias(component)).distinct()
    again = _nodes_of(again, text, node, width).join(stay, (col(id_column) == col(key)) & col(node).eqNullSafe(col(node + "_")))
    # rows without words have no component: one of each id. Of rows that differ, the one whose columns hash lowest stays
    whole = F.struct(*[col(c) for c in docs.columns])
    lowest = F.min_by(whole, F.struct(F.xxhash64(F.to_json(whole)), F.to_json(whole)))
    one = again.groupBy(col(id_column), col(component)).agg(lowest.alias("row")).select("row.*")
    return left.unionByName(one)
