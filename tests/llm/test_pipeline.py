"""The pipeline stage by stage against what each stage must keep."""

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from hourweave.llm import quality_rules as qr
from hourweave.session import materialise
from tests.llm.test_duplicates import groups

GOOD = "the and of to in that it is was for on with as at by".split()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Good prose with copies and near-copies, junk, odd rows, an added column; and the labels of most."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("etaoinshr") for _ in range(r.randint(2, 7)))
    prose = lambda n: " ".join(r.choice(GOOD) if r.random() < 0.4 else word() for _ in range(n))
    rows, labels = [], []
    for i in range(60):
        rows.append((i, prose(r.randint(60, 120)), "en", r.choice("aab")))
        labels.append((i, 1, 0))
    for i in range(60, 100):
        rows.append((i, " ".join(word() + r.choice(["###", "$$$", "%%%"]) for _ in range(80)), "en", "b"))
        labels.append((i, 0, 0))
    rows += [(100 + i, rows[i][1], "en", "c") for i in range(10)]
    rows += [(120 + i, rows[20 + i][1] + " end", "en", "c") for i in range(10)]
    rows += [(140, None, None, None), (141, "", "en", "a"), (142, " \n ", "en", "a"), (None, prose(80), "en", "a"), (0, rows[0][1], "en", rows[0][3])]
    folder = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, bucket int"
    spark.createDataFrame([(*x, len(x[1] or ""), 0.1, 3) for x in rows], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, dict(labels_of=dict((a, b) for a, b, _ in labels))


def test_stages(spark, corpus):
    folder, known = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates", "source_mix", "packing"]
    before, after = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        found = materialise(stage(spark, before, folder), name)
        after[name] = found
        if name != "packing":
            assert found.columns == names
            before = found
    rows = {k: v.collect() for k, v in after.items()}
    # the classifier keeps the labelled good documents and drops the junk
    kept = {x.doc_id for x in rows["quality_classifier"]}
    assert set(range(60)) <= kept and not kept & set(range(60, 100))
    # the rules keep exactly what the table says
    judged = qr.judge(after["quality_classifier"], prefix="q_").where("q_kept").collect()
    assert Counter(x.doc_id for x in rows["quality_rules"]) == Counter(x.doc_id for x in judged)
    # one document of each group
    given = [(x.doc_id, x.text) for x in rows["quality_rules"]]
    want = {i for i, (_, _, keep) in groups([g for g in given if g[0] is not None]).items() if keep}
    left = [x.doc_id for x in rows["near_duplicates"]]
    assert Counter(i for i in left if i is not None) == Counter(want)
    assert sum(i is None for i in left) == sum(i is None for i, _ in given)
    # the mix repeats whole documents, three times at most, and comes near the words it had
    copies = Counter(x.doc_id for x in rows["source_mix"])
    assert set(copies) <= set(left) and max(copies.values()) <= 3
    words = lambda xs: sum(len(x.text.split()) for x in xs)
    assert abs(words(rows["source_mix"]) - words(rows["near_duplicates"])) < 0.05 * words(rows["near_duplicates"])
    # every row of the mix is packed
    assert Counter(x.doc_id for x in rows["packing"]) == copies
    batches = defaultdict(list)
    for x in rows["packing"]:
        batches[x.batch].append(x)
    assert all(len({x.bucket for x in xs}) == 1 and sorted(x.place for x in xs) == list(range(len(xs))) for xs in batches.values())


def test_run_and_empty(spark, corpus, tmp_path):
    folder, _ = corpus
    assert corpus_pipeline.run(spark, folder).count() > 0
    nothing = str(tmp_path)
    for table in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{nothing}/{table}.parquet")
    assert corpus_pipeline.run(spark, nothing).count() == 0
