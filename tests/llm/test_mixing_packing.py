"""Mixing and packing against exhaustive or step-by-step versions."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hourweave.llm import mixing, packing
from hourweave.llm.common import word_count
from hourweave.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes, weights, most=3):
    """Targets by handing the excess on until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names) if sizes[s]}
    total, target = sum(sizes.values()), {s: 0.0 for s in names}
    free = set(weight)
    while free:
        left = total - sum(target[s] for s in weight if s not in free)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = most * sizes[s]
        free -= over
    return target


@pytest.fixture(scope="module")
def mixed(spark):
    r = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(r.randint(0, 60))), r.choice(["a"] * 6 + ["b", "c", "d", "É", None])) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_rows_without_ids_of_one_size(spark):
    """Texts tell them apart, so a source without ids comes near its target like any other."""
    rows = [(None if s == "a" else i, f"w{i} " * 10, s) for s, n in (("a", 1000), ("b", 500)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {"a": 10_000, "b": 5_000}
    want = fill(sizes, (1, 2, 3))
    for block_rows in (16, 512, 4096):
        taken = Counter()
        for r in mixing.draw_mix(df, word_count(F.col("text")), (1, 2, 3), block_rows=block_rows).collect():
            taken[r.source] += r.mix_size * len(r.mix_draws)
        assert all(abs(taken[s] - want[s]) <= 10 for s in sizes)


def test_targets_takings_and_shards(mixed):
    rows, df = mixed
    draw = lambda: mixing.draw_mix(df, word_count(F.col("text")), (1, 2, 3), shards=8, block_rows=16)
    got = draw().collect()
    sizes, taken, per_shard = defaultdict(int), defaultdict(int), Counter()
    for r in got:
        sizes[r.source] += r.mix_size
        taken[r.source] += r.mix_size * len(r.mix_draws)
        per_shard.update(d["shard"] for d in r.mix_draws)
        assert len(r.mix_draws) <= 3 and r.mix_size == len(r.text.split())
        assert len({d["pass"] for d in r.mix_draws}) == len(r.mix_draws)
    want = fill(sizes, (1, 2, 3))
    for r in got:
        assert r.mix_source_size == sizes[r.source] and r.mix_target == pytest.approx(want[r.source], abs=1e-6)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60
    assert set(per_shard) == set(range(8)) and max(per_shard.values()) < 2 * min(per_shard.values())
    assert sorted(map(str, got)) == sorted(map(str, draw().collect()))


def test_splitting_tree_is_exact(spark):
    plan = spark.createDataFrame([(0, 1000), (1, 37), (2, 0), (3, 250)], "rank int, quota long").where("quota > 0")
    limits = {r["rank"]: r.limits for r in mixing.split_quotas(plan, 7, 3).collect()}
    assert {k: v[-1] for k, v in limits.items()} == {0: 1000, 1: 37, 3: 250}
    assert all(len(v) == 7 and v == sorted(v) for v in limits.values())
    ends = [sum(v[k] for v in limits.values()) for k in range(7)]
    assert ends == [1287 * (k + 1) // 7 for k in range(7)]


@pytest.mark.parametrize("total, marked, drawn", [(10, 4, 5), (60, 7, 30), (500, 250, 100), (40, 40, 13), (9, 0, 4)])
def test_hypergeometric_inverse(spark, total, marked, drawn):
    grid = spark.range(400).withColumn("u", (F.col("id") + 0.5) / 400)
    x = mixing._hypergeometric(F.lit(total).cast("long"), F.lit(marked).cast("long"), F.lit(drawn).cast("long"), F.col("u"))
    ways = [math.comb(marked, k) * math.comb(total - marked, drawn - k) if k <= marked and drawn - k <= total - marked else 0 for k in range(drawn + 1)]
    reached = list(itertools.accumulate(w / math.comb(total, drawn) for w in ways))
    for r in grid.select("u", x.alias("x")).collect():
        assert r.x == next(k for k, p in enumerate(reached) if p >= r.u - 1e-12 and ways[k]), (r.u, r.x)


def test_mix_odd_rows(docs, empty):
    size = word_count(F.col("text"))
    got = mixing.draw_mix(docs, size, (1, 2, 3))
    assert got.columns[: len(docs.columns)] == docs.columns and got.count() == docs.count()
    rows = mixing.mix_rows(docs, size, (1, 2, 3), shuffle=True, shards=3)
    assert rows.columns == docs.columns
    assert rows.count() == got.select(F.sum(F.size("mix_draws"))).first()[0]
    assert mixing.draw_mix(empty, size, (1, 2, 3)).count() == 0 and mixing.mix_rows(empty, size, (1, 2, 3)).count() == 0


def test_mix_query(spark, sf_dir):
    got = QUERIES["op3_source_mix"](spark, sf_dir).collect()
    rows = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size == len(WORD.findall(rows[r.doc_id].text or "")) and r.taken <= 3 * r.size
        sizes[rows[r.doc_id].source] += r.size
        taken[rows[r.doc_id].source] += r.taken
    want = fill(sizes, (1, 2, 3))
    assert all(r.target == pytest.approx(want[rows[r.doc_id].source]) and r.source_size == sizes[rows[r.doc_id].source] for r in got)
    assert abs(sum(taken.values()) - sum(sizes.values())) < 0.01 * sum(sizes.values())


def test_mix_runs_no_python(spark, sf_dir):
    plan = QUERIES["op3_source_mix"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def least_padding(cells, buckets):
    n, best = len(cells), None
    for r in range(min(buckets, n)):
        for cut in itertools.combinations(range(n - 1), r):
            start, pad = 0, 0
            for end in (*cut, n - 1):
                pad += sum(cells[end][0] * c - s for _, c, s in cells[start : end + 1])
                start = end + 1
            best = pad if best is None else min(best, pad)
    return best


def test_tops_are_optimal():
    r = random.Random(1)
    for _ in range(200):
        lengths = sorted(r.sample(range(60), r.randint(1, 9)))
        cells = [(x, c, x * c - (x > 3) * r.randint(0, 2)) for x, c in ((x, r.randint(1, 9)) for x in lengths)]
        k = r.randint(1, 5)
        tops, padding = packing.choose_tops(cells, k)
        assert len(tops) <= k and padding == least_padding(cells, k)
        assert padding == sum(min(t for t in tops if t >= x) * c - s for x, c, s in cells)
    assert packing.choose_tops([], 4) == ([], 0)


def test_batches(spark):
    r = random.Random(2)
    rows = [(i, int(r.paretovariate(0.7) * 10) % 20_000) for i in range(4000)] + [(i, 12) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, n long")
    got = packing.pack(df, F.col("n"), buckets=6, budget=4096).collect()
    assert Counter((x.doc_id, x.length) for x in got) == Counter(rows)
    batches = defaultdict(list)
    for x in got:
        batches[x.batch].append(x)
        assert x.length <= x.bucket_length
    assert sorted(batches) == list(range(len(batches)))
    full = defaultdict(list)
    for xs in batches.values():
        assert len({x.bucket for x in xs}) == 1 and sorted(x.place for x in xs) == list(range(len(xs)))
        room = max(1, 4096 // max(1, xs[0].bucket_length))
        assert len(xs) <= room
        full[xs[0].bucket].append(len(xs) < room)
    assert all(sum(x) <= 1 for x in full.values())
    cells = [(n, c, n * c) for n, c in sorted(Counter(n for _, n in rows).items()) if n < 4096]
    assert packing.length_cells(df.where("n < 4096").withColumnRenamed("n", "length")) == cells


def test_pack_odd_rows(docs, empty):
    got = packing.pack(docs, word_count(F.col("text"))).collect()
    assert Counter((x.doc_id, x.length) for x in got) == Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in docs.collect())
    assert packing.pack(empty, word_count(F.col("text"))).count() == 0


def test_pack_query(spark, sf_dir):
    got = QUERIES["op1_length_buckets"](spark, sf_dir).collect()
    want = {r.doc_id: len(WORD.findall(r.text or "")) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {x.doc_id: x.length for x in got} == want
