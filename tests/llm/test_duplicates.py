"""Near-duplicate groups against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hourweave.llm import near_duplicates as nd
from hourweave.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def groups(rows, percent=85):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = root(a), root(b)
                parent[max(u, v)] = min(u, v)
    return {i: (len(sets[i]), root(i), i == root(i)) for i in sets}


@pytest.fixture(scope="module")
def variants():
    r = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(200):
        words = list(base)
        for _ in range(r.randint(0, 6)):
            words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(i, " ".join(r.choice(base) for _ in range(r.randint(0, 40)))) for i in range(200, 240)]
    return rows + [(400, None), (401, ""), (402, "a b"), (403, "A B"), (404, "a b c"), (405, "Ä b"), (406, "ä b")]


@pytest.mark.parametrize("cluster_most", [nd.CLUSTER_MOST, 3])
def test_groups_equal_all_pairs(spark, variants, cluster_most):
    df = spark.createDataFrame(variants, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.group_duplicates(df, cluster_most=cluster_most).collect()}
    assert got == groups(variants)


def test_links_contracted_across_tasks(spark):
    chain = [(bytes([i // 256, i % 256]), bytes([(i + 1) // 256, (i + 1) % 256])) for i in range(300) if i % 60 != 59]
    df = spark.createDataFrame(chain, "a binary, b binary").repartition(8)
    for together in (0, 10**6):
        got = {bytes(r.node): bytes(r.component) for r in nd.components(df, together).collect()}
        for i in range(301):
            name = bytes([i // 256, i % 256])
            first = i // 60 * 60
            assert got.get(name, name) == bytes([first // 256, first % 256]), i


def test_odd_rows(docs):
    got = Counter(tuple(r) for r in nd.group_duplicates(docs).collect())
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = groups([r for r in rows if r[0] is not None])
    assert sum(got.values()) == len(rows)
    assert got == Counter((i, *want[i]) if i is not None else (None, 1, None, True) for i, _ in rows)


def test_deduplicate_keeps_one_of_each_group(docs, empty):
    left = nd.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect() if r.doc_id is not None)) == [1, 4, 5, 6, 7, 9, 10, 11, 13, 14]  # 12 has the shingles of 1
    assert left.where("doc_id is null").count() == 1
    assert nd.deduplicate(empty).count() == 0


def test_signature_estimates_likeness():
    r = np.random.default_rng(1)
    for n, share in ((3, 0.5), (50, 0.8), (2000, 0.3)):
        errors = []
        for _ in range(30):
            both = r.integers(0, 2**63, n).astype(np.uint64)
            k = int(n * share)
            a, b = np.append(both[:k], r.integers(0, 2**63, n - k).astype(np.uint64)), np.append(both[:k], r.integers(0, 2**63, n - k).astype(np.uint64))
            true = k / (2 * n - k)
            errors.append((nd.signature(a) == nd.signature(b)).mean() - true)
        assert abs(np.mean(errors)) < 0.03


def test_signature_is_the_sequential_one():
    """Element by element with early stopping gives the registers of the vectorised rounds."""
    elements = nd.shingles(" ".join(f"w{i}" for i in range(40)))
    want = np.full(nd.REGISTERS, np.iinfo(np.int64).max, np.int64)
    for e in elements:
        order = list(range(nd.REGISTERS))
        for j in range(nd.REGISTERS):
            draw = int(nd._mix(np.array([(int(e) + (j + 1) * 0xD1B54A32D192ED03) % (1 << 64)], np.uint64))[0])
            k = j + ((draw & 0xFFFFFF) * (nd.REGISTERS - j) >> 24)
            order[j], order[k] = order[k], order[j]
            want[order[j]] = min(want[order[j]], (draw >> 24) + (j << 40))
            if want.max() < (j + 1) << 40:
                break
    assert (nd.signature(elements) == want).all()


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op10_near_duplicates"](spark, sf_dir).collect()}
    assert got == groups(rows)


def spans(r, n, starts):
    """Texts that are windows of one word sequence: their likeness follows from the distance."""
    words = [f"s{r.randrange(10**9)}" for _ in range(n + max(starts))]
    return [" ".join(words[k : k + n]) for k in starts]


def test_stage_links_from_080_on(spark):
    """Pairs between 0.80 and 0.85 are near-duplicates for the pipeline; at 0.79 they are not."""
    r, rows = random.Random(7), []
    for n, shift in ((104, 11), (94, 9), (204, 20), (904, 95), (104, 12)):
        for _ in range(8):
            rows += [(len(rows) + k, t) for k, t in enumerate(spans(r, n, (0, shift)))]
    likeness = [100 * len(a & b) / len(a | b) for a, b in zip(*[iter([shingle_set(t) for _, t in rows])] * 2)]
    assert sum(80 <= x < 85 for x in likeness) == 32 and sum(78 < x < 80 for x in likeness) == 8
    want = {i for i, (_, _, keep) in groups(rows, 80).items() if keep}
    assert want != {i for i, (_, _, keep) in groups(rows, 85).items() if keep}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id for x in corpus_pipeline.near_duplicates_stage(spark, df, "").collect()} == want


@pytest.mark.parametrize("percent", [30, 50, 80])
def test_lower_thresholds_equal_all_pairs(spark, variants, percent):
    r = random.Random(8)
    rows = variants + [(1000 + 2 * g + k, t) for g in range(60) for k, t in enumerate(spans(r, 64, (0, r.randint(1, 50))))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in nd.group_duplicates(df, percent=percent).collect()}
    assert got == groups(rows, percent)


def test_recall_follows_the_threshold():
    assert nd.banding(85) == (25, 5) and nd.banding(80) == (37, 5) and nd.banding(100)[0] == 1
    for percent in range(5, 100):
        bands, rows = nd.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= nd.MISSED_BANDS
        assert nd.least_alike(percent) < percent / 100
    with pytest.raises(ValueError):
        nd.banding(0)


def test_every_pair_of_a_large_bucket_is_compared(spark):
    """The largest component of the bucket changes after the first round; no pair may be left out for it."""
    name = lambda i: bytes([i])
    parts = [range(0, 26), range(26, 48), range(48, 70), range(70, 100)]  # A, B1, B2, single ones
    first = {i: part[0] for part in parts[:3] for i in part} | {i: i for i in parts[3]}
    buckets = spark.createDataFrame([(1, name(i)) for i in first], "key long, node binary")
    tree = spark.createDataFrame([(name(c), name(i)) for i, c in first.items() if i != c], "a binary, b binary")
    compared: set[tuple[int, int]] = set()
    rounds = []

    def compare(pairs):
        new = {(r.a[0], r.b[0]) for r in pairs.collect()}
        rounds.append(len(new))
        compared.update(new)
        # every member of B1 is like every one of B2; nothing else is alike
        return spark.createDataFrame([(name(a), name(b)) for a, b in new if a in parts[1] and b in parts[2]], "a binary, b binary")

    found = {r.node[0]: r.component[0] for r in nd.compare_leaders(buckets, tree, nd.components(tree), compare).collect()}
    assert len(rounds) == 2 and {found.get(i, i) for i in (*parts[1], *parts[2])} == {26}
    assert {(i, j) for i in first for j in range(i + 1, 100) if found.get(i, i) != found.get(j, j)} <= compared


def test_one_id_with_several_texts(spark):
    """Rows are removed by id and text: no unlike text of a repeated id is lost, and one row of each group stays."""
    r = random.Random(9)
    a, b, c, d, e = (" ".join(f"t{r.randrange(10**9)}" for _ in range(60)) for _ in range(5))
    rows = [(1, a), (5, a + " end"), (5, b), (7, c), (7, d), (7, d), (8, d + " end"), (9, e), (9, e + " end"), (10, ""), (10, None), (10, e + " stop"), (11, "alone"), (None, a), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row__node", F.lit("kept"))
    left = nd.deduplicate(df)
    assert left.columns == df.columns
    got = Counter((x.doc_id, x.text and x.text.removesuffix(" end") or "") for x in left.collect())
    assert got == Counter([(1, a), (5, b), (7, c), (7, d), (9, e), (10, ""), (11, "alone"), (None, a), (None, a)])


def test_rows_of_one_id_that_differ_in_other_columns(spark):
    """One row of each id and group stays, the same whatever the order of the rows."""
    text = "the quick brown fox and the lazy dog walk to the old town by the river"
    rows = [(1, text, "a", 3), (1, text, "b", 1), (1, text, "c", 2), (2, text, "d", 9), (3, "", "e", 1), (3, None, "f", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    kept = {tuple(nd.deduplicate(d).orderBy("doc_id").collect()) for d in (df, df.orderBy("source"), df.orderBy(F.desc("source")).repartition(5))}
    assert len(kept) == 1 and [r.doc_id for r in next(iter(kept))] == [1, 3]
