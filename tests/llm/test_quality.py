"""Rules against plain Python and SQL; the classifier against labels it has not seen."""

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourweave.llm import near_duplicates as nd
from hourweave.llm import quality_classifier as qc
from hourweave.llm import quality_rules as qr
from hourweave.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import difference, duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated))


def test_counts(docs):
    got = Counter(tuple(r) for r in qr.judge(docs, prefix="q_").select("doc_id", "q_n_words", "q_word_chars", "q_n_symbols", "q_n_dup_lines", "q_n_repeat_words").collect())
    assert got == Counter((r.doc_id, *counts(r.text)) for r in docs.collect())


def test_base_rule_and_table(docs, empty):
    for r in qr.judge(docs, prefix="q_").collect():
        n, _, symbols, _, repeats = counts(r.text)
        assert r.q_base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert not (r.q_kept and r.q_base_failed)
        assert not (r.q_kept and symbols > 0.1 * n)
    assert qr.judge(empty, prefix="q_").count() == 0


def test_one_rule_at_a_time(spark):
    text = "of the and to " * 5 + " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (2, text + " $$$" * 30), (3, text.upper()), (4, text.replace("of", "qx").replace("the", "qy").replace("and", "qz").replace("to", "qw"))], "doc_id long, text string")
    for rule, fails in (("symbol_ratio", {2}), ("upper_ratio", {3}), ("stop_word_ratio", {3, 4})):
        rules = [r for r in qr.RULES if r.measure == rule]
        assert {r.doc_id for r in qr.measure(df).where(qr.compile_rules(rules)).collect()} == fails


def test_keep_good_keeps_columns(docs):
    kept = qr.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in qr.judge(docs, prefix="q_").where("q_kept").collect()}


def test_every_added_name_as_a_column(spark, docs, tmp_path):
    """Columns of a table that have the names of counts, verdicts and helpers stay as they are."""
    plain = docs.select("doc_id", "text")
    taken = plain.withColumns({c: F.lit(7) for c in (*qr.ADDED, "words__", "lines__", "windows__", "repeats__", "rule__kept", "_n_words")})
    judged = qr.judge(taken)
    assert judged.columns[: len(taken.columns)] == taken.columns and judged.where("n_words <> 7 OR kept <> 7 OR words__ <> 7 OR rule__kept <> 7").isEmpty()
    added = judged.columns[len(taken.columns) :]
    assert [c.lstrip("_") for c in added] == list(qr.ADDED)
    own = {(r.doc_id, r[added[-1]], r[added[0]]) for r in judged.collect()}
    assert own == {(r.doc_id, r.kept, r.n_words) for r in qr.judge(plain).collect()}
    kept = qr.keep_good(taken)
    assert kept.columns == taken.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in qr.keep_good(plain).collect())
    taken.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    query = QUERIES["op5_quality_rules"](spark, str(tmp_path))
    assert {(r.doc_id, r.kept, r.n_words) for r in query.collect()} == own


def test_rules_run_no_python(spark, sf_dir):
    plan = QUERIES["op5_quality_rules"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_rules_equal_sql(spark, sf_dir):
    assert difference(QUERIES["op5_quality_rules"](spark, sf_dir), duck(sf_dir), ORACLE_SQL["op5_quality_rules"]) is None


def test_features_are_distinct_indicators():
    row, feature = qc.features(["a b a b", "", "A b!", None or ""])
    assert set(row) == {0, 2}
    assert len({(a, b) for a, b in zip(row, feature)}) == len(row)
    assert (row == 0).sum() == 4  # a, b, "a b", "b a"


def test_descent_reaches_the_optimum():
    """The duality gap of the fit is small."""
    r = np.random.default_rng(2)
    rows = [np.unique(r.integers(0, 40, 12)) for _ in range(120)]
    y = np.where(np.array([(x < 15).sum() for x in rows]) > 4, 1.0, -1.0)
    ratio, cost = qc.log_count_ratio(rows, y, 64), np.ones(len(rows))
    w, b = qc.dual_coordinate_descent(rows, y, ratio, cost, epochs=2000)
    unit = [ratio[f] / np.sqrt(ratio[f] @ ratio[f]) for f in rows]
    loss = sum(max(0.0, 1 - t * (w[f] @ v + b)) for f, v, t in zip(rows, unit, y))
    primal = (w @ w + b * b) / 2 + loss
    for _ in range(300):  # no small step does better
        dw, db = r.normal(0, 0.01, len(w)), r.normal(0, 0.01)
        other = ((w + dw) @ (w + dw) + (b + db) ** 2) / 2 + sum(max(0.0, 1 - t * ((w + dw)[f] @ v + b + db)) for f, v, t in zip(rows, unit, y))
        assert other > primal - 1e-2


def traced(f):
    """What `f` gives, and the bytes that are left of it and were the most while it ran."""
    tracemalloc.start()
    try:
        return f(), *tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()


def test_fit_holds_little_more_than_its_rows():
    """Kept unit vectors of all rows took twice the rows, the counts of all features at once three times."""
    r = np.random.default_rng(3)
    rows = [np.unique(r.integers(0, 4096, 3000)).astype(np.int32) for _ in range(3000)]
    labels = [int((f < 1000).sum() > 520) for f in rows]
    model, _, most = traced(lambda: qc.fit_rows([f"{i}" for i in range(len(rows))], labels, rows, 12))
    assert model[0].any() and most < sum(f.nbytes for f in rows)


def test_remembered_words_are_few(monkeypatch):
    monkeypatch.setattr(nd, "_words", {})
    values = [" ".join(f"word{i}" for i in range(k, k + 1000)) for k in range(0, 200_000, 1000)]
    assert traced(lambda: [nd.shingles(x).size for x in values])[1] < 16e6


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op6_quality_classifier"](spark, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    seen = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in seen if y == 1], [s for s, y in seen if y == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([s >= 0.3 for s in good]) > 0.97


@pytest.mark.parametrize("labels", [[], [(3, 1), (1, 1)], [(3, 1), (3, 0), (10, 0), (1, 1), (13, None), (None, 0)]])
def test_few_labels(spark, docs, labels):
    model = qc.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"), bits=12)
    scored = qc.score(docs, model, name="p")
    assert scored.columns == [*docs.columns, "p"]
    rows = scored.collect()
    assert len(rows) == docs.count() and all(0 <= r.p <= 1 for r in rows)
    assert len({r.p for r in rows if not (r.text or "").strip()}) == 1


def test_copies_of_labelled_rows_do_not_grow_the_fit(spark, monkeypatch):
    """A labelled id a hundred thousand times, with one text and with many: the fit reads at most `max_rows` rows."""
    base = [(i, f"text {i} of the best kind" if i % 2 else f"### {i} $$$ %%%") for i in range(40)]
    rows = spark.createDataFrame(base, "doc_id long, text string")
    many = rows.unionByName(spark.range(100_000).selectExpr("3 AS doc_id", "'text 3 of the best kind' AS text")).unionByName(
        spark.range(5_000).selectExpr("4 AS doc_id", "concat('### ', id, ' $$$ %%%') AS text"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    assert qc.training_rows(many, labels, max_rows=60, bits=12).count() == 60
    assert qc.training_rows(many, labels, max_rows=10**6, bits=12).count() == 40 + 5_000 - 1  # id 4 has one of the texts already
    assert qc.training_rows(rows, labels, max_rows=20, bits=12).count() == 20
    copies = rows.unionByName(rows).unionByName(rows)
    assert qc.fit(copies, labels, bits=12) == qc.fit(rows, labels, bits=12)


def test_labels_of_other_rows_never_matter(spark, docs):
    """Scores follow from texts alone."""
    r = random.Random(1)
    texts = [" ".join(r.choice(["good", "fine", "nice"] if k % 2 else ["bad", "ugly", "poor"]) for _ in range(20)) for k in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = qc.fit(df, spark.createDataFrame([(k, k % 2) for k in range(80)], "doc_id long, quality int"), bits=12)
    twice = df.unionByName(df.selectExpr("doc_id + 1000 AS doc_id", "text"))
    scores = {x.doc_id: x.score for x in qc.score(twice, model).collect()}
    assert all(scores[k] == scores[k + 1000] and (scores[k] > 0.5) == (k % 2 == 1) for k in range(80))
