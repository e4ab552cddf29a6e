"""Removed spans against every string of 50 bytes."""

import hashlib
import random

import numpy as np
import pytest

from hourweave.llm import repeated_spans as rs
from hourweave.llm.queries import QUERIES

N = rs.LENGTH


def expected(rows):
    """Digest columns of each row, as a sorted list."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, t in texts:
        for o in range(len(t) - N + 1):
            if i is not None and least.get(t[o : o + N], i) >= i:
                least[t[o : o + N]] = i
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for o in range(len(t) - N + 1):
            if i is not None and least[t[o : o + N]] < i:
                gone[o : o + N] = b"\1" * N
        spans = sum(1 for o in range(len(t)) if gone[o] and (not o or not gone[o - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def cases(seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(40)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    passages = [prose(r.randint(8, 60)) for _ in range(6)] + ["x" * 60, "ab" * 40, prose(30)[: N - 1], prose(30)[:N], prose(30)[: N + 1]]
    rows = []
    for i in range(120):
        parts = [prose(r.randint(0, 50))]
        for _ in range(r.randint(0, 4)):
            passage = r.choice(passages)
            if r.random() < 0.4:  # a changed copy
                at = r.randrange(len(passage))
                passage = passage[:at] + r.choice("zyx ") + passage[at + r.randint(0, 2) :]
            if r.random() < 0.3:
                a = r.randrange(len(passage))
                passage = passage[a : a + r.randint(40, 90)]
            parts += [passage, prose(r.randint(0, 12))]
        rows.append((r.randint(0, 400) - 50, "".join(parts)))
    rows += [(i, t) for i, t in rows[:10]] + [(500 + i, t) for i, (_, t) in enumerate(rows[:10])]
    return rows + [(None, rows[0][1]), (None, None), (7, None), (8, ""), (9, "y" * 49), (10, "y" * 50), (11, "y" * 51), (12, "y" * 5000), (13, "z" + "y" * 300 + "z")]


SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("slice_bytes, bucket_bytes, contexts", [(rs.SLICE_BYTES, rs.BUCKET_BYTES, rs.CONTEXTS), (2000, 3000, 64), (1500, 1500, 0), (4000, 900, 1)])
def test_equals_all_strings(spark, slice_bytes, bucket_bytes, contexts):
    rows = cases(slice_bytes)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(rs.remove_repeats(df, slice_bytes=slice_bytes, bucket_bytes=bucket_bytes, contexts=contexts)) == expected(rows)


def test_long_documents_go_block_by_block(spark, monkeypatch):
    """Anchors found in blocks are those found at once."""
    import pyarrow as pa

    r = random.Random(4)
    table = pa.table({"key": [1, 2, 3], "bytes": [bytes(r.choice(b"abcd ") for _ in range(n)) for n in (5000, 30, 700)]})
    whole = rs.Slice(table).anchors()
    for block in (1, 7, 64, 1000):
        monkeypatch.setattr(rs, "BLOCK", block)
        for a, b in zip(whole, rs.Slice(table).anchors()):
            assert np.array_equal(a, b)


def test_bucket_pointers():
    r = random.Random(8)
    data = np.frombuffer(bytes(r.choice(b"ab") for _ in range(40)) * 12 + bytes(r.choice(b"ab") for _ in range(600)), np.uint8)
    starts = np.arange(len(data) - N + 1)
    ids = np.array([r.randint(0, 5) for _ in starts])
    least = {}
    for o, i in zip(starts, ids):
        key = data[o : o + N].tobytes()
        least[key] = min(i, least.get(key, i))
    assert rs.repeated_windows(data, starts, ids).tolist() == [bool(i > least[data[o : o + N].tobytes()]) for o, i in zip(starts, ids)]


def test_texts_are_shuffled_once(spark):
    df = spark.createDataFrame(cases(1), SCHEMA)
    plan = rs.remove_repeats(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(slice") >= 3
    out = rs.remove_repeats(df)
    out.collect()
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("ReusedExchange") >= 2


def test_empty_table_and_further_columns(spark, docs):
    assert got(rs.remove_repeats(docs.limit(0))) == []
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(rs.remove_repeats(docs)) == expected(rows)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op13_repeated_spans"](spark, sf_dir)) == expected(rows)
