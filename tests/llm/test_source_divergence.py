"""Divergences of sources against sums over every term, in exact integers."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hourweave.llm import source_divergence as sd
from hourweave.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import difference, duck

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least=10, top=10):
    rows = [tuple(x or "" for x in r) for r in rows]
    n, d = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall(text.translate(LOWER))
        n[lang, source].update(terms)
        d[lang].update(set(terms))
    out = []
    for lang in {r[1] for r in rows}:
        kept = [t for t, c in d[lang].items() if c >= least]
        groups = {s: {t: n[lang, s][t] for t in kept} for _, la, s in rows if la == lang}
        whole = {t: sum(g[t] for g in groups.values()) for t in kept}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    words = [f"{a}{b}" for a in ("Ab", "ça", "é", "x", "zebra", "Z", "日本") for b in "abcdefgh"]
    out = []
    for i in range(300):
        source = r.choice([None, "", "a", "a", "a", "a", "b", "c", "É", "x9"])
        pick = words[: r.choice([5, 20, 56])]
        out.append((" ".join(r.choice(pick) + r.choice(["", ".", " 12 ", "_", "\x7f", "\n"]) for _ in range(r.randint(0, 60))), r.choice(["en", "en", None, "de"]), source))
    # a language without kept terms, and groups without terms
    return out + [("rare words", "fr", "a"), (None, "fr", "b"), (None, "en", "none"), ("", "en", None)] + out[:5]


SCHEMA = "text string, lang string, source string"


@pytest.mark.parametrize("held", [sd.HELD, 0])
def test_equals_every_term(spark, rows, held, monkeypatch):
    monkeypatch.setattr(sd, "HELD", held)
    assert got(sd.source_divergence(spark.createDataFrame(rows, SCHEMA).repartition(6))) == expected(rows)


def test_other_thresholds(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for least, top in ((1, 3), (10**6, 5)):
        assert got(sd.source_divergence(df, least=least, top=top)) == expected(rows, least, top)


def test_tree_shares_paths(spark):
    """Corrections of equal and of overlapping rows, against sums over rows."""
    r = random.Random(6)
    paths = []
    for _ in range(200):
        sources = sorted(r.sample("abcdef", r.randint(2, 5)))
        paths.append(("en", [(s, r.choice([900, 1500]), 50 + ord(s)) for s in sources], r.randint(1, 4)))
    f = lambda p, q: (p - q) ** 2 // (p + q)
    sums = Counter()
    for lang, path, m in paths:
        for i, (a, pa, za) in enumerate(path):
            for b, pb, zb in path[i + 1 :]:
                sums[lang, a, b] += m * (f(pa, pb) - f(pa, zb) - f(za, pb) + f(za, zb))
    df = spark.createDataFrame(paths, "lang string, path array<struct<source:string,p:long,zero:long>>, m long")
    for parts in (1, 7):
        found = sd.tree_corrections(df.repartitionByRange(parts, "lang", "path").sortWithinPartitions("lang", "path"))
        assert {(x.lang, x.a, x.b): x.value for x in found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).collect()} == dict(sums)


def test_large_counts_stay_exact(spark):
    values = [(10**12, 3 * 10**15, 7), (0, 5, 1), (9 * 10**14, 9 * 10**14, 10**9)]
    df = spark.createDataFrame(values, "c long, n long, v long")
    assert [x.p for x in df.select(sd.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()] == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in values]


def test_empty_table_and_further_columns(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"term": F.lit("x"), "p": F.lit(1), "item": F.lit(2), "value": F.lit(3)})
    assert got(sd.source_divergence(df.limit(0))) == []
    assert got(sd.source_divergence(df)) == expected(rows)


def test_sql_on_odd_rows(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duck("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert difference(QUERIES["op11_source_divergence"](spark, str(tmp_path)), con, ORACLE_SQL["op11_source_divergence"]) is None
