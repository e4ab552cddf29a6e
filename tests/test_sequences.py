"""Windows of several columns against a plain loop."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hourweave.operators import windows as W

FEED = "TimestampHour timestamp_ntz, SettlementPoint string, load double, price double, extra string"


@pytest.fixture(scope="module")
def feed(spark, hour):
    rng = random.Random(2)
    rows = []
    for key, share in (("hot", 0.995), ("gappy", 0.9), ("short", 1.0)):
        for h in range(20 if key == "short" else 900):
            if rng.random() < share:
                rows.append((hour(h - 400), key, None if rng.random() < 0.003 else float(h), rng.choice([None, -float(h)]) if rng.random() < 0.01 else -float(h), "x"))
    # repeated hours, null keys and hours
    rows += [rows[3][:2] + (1e9, 1e9, "y"), (None, "hot", 1.0, 1.0, "z"), (hour(0), None, 1.0, 1.0, "z")]
    return spark.createDataFrame(rows, FEED).cache()


def _plain(feed, history, horizon, hour):
    held = {}
    for r in feed.collect():
        if r.TimestampHour is not None and r.SettlementPoint is not None:
            load, price = held.get((r.SettlementPoint, r.TimestampHour), (None, None))
            least = lambda a, b: b if a is None else a if b is None else min(a, b)
            held[r.SettlementPoint, r.TimestampHour] = (least(load, r.load), least(price, r.price))
    out = {}
    for key, last in held:
        step = [held.get((key, last - (hour(1) - hour(0)) * i)) for i in range(history + horizon)][::-1]
        early, late = step[:history], step[history:]
        if all(x is not None and x[0] is not None and x[1] is not None for x in early) and all(x is not None and x[1] is not None for x in late):
            out[key, last] = ([x[0] for x in early], [x[1] for x in early], [x[1] for x in late])
    return out


@pytest.mark.parametrize(("history", "horizon", "length"), [(168, 24, 192), (168, 24, 240), (24, 1, 25), (1, 1, 2)])
def test_windows_equal_a_plain_loop(feed, hour, history, horizon, length):
    chunks = W.sequence_chunks(feed, ["load", "price"], length)
    got = W.sequences(chunks, history, horizon, past=["load", "price"], target=["price"]).collect()
    want = _plain(feed, history, horizon, hour)
    assert want and len(got) == len(want)
    for r in got:
        assert (r.load_history, r.price_history, r.price_future) == want[r.SettlementPoint, r.TimestampHour]


def test_index_selects_windows(feed):
    chunks = W.sequence_chunks(feed, ["load", "price"], 30)
    index = W.sequence_index(chunks, 24, 6, ["load"], target=["price"])
    every = W.sequences(chunks, 24, 6, past=["load"], target=["price"])
    assert index.count() == every.count() == index.distinct().count()
    some = index.where("chunk % 3 = 0 AND offset % 2 = 0")
    kept = W.sequences(chunks, 24, 6, past=["load"], target=["price"], index=some)
    assert 0 < kept.count() == some.count() and kept.exceptAll(every).isEmpty()


def test_chunks_hold_each_row_once(feed):
    chunks = W.sequence_chunks(feed, ["load", "price"], 192).cache()
    rows = feed.where("TimestampHour IS NOT NULL AND SettlementPoint IS NOT NULL").select("TimestampHour", "SettlementPoint").distinct().count()
    assert chunks.select(F.explode("slots").alias("s")).where("s IS NOT NULL").count() == rows
    assert chunks.agg(F.max(F.size("slots"))).first()[0] == 192
    assert chunks.where("SettlementPoint = 'hot'").count() >= math.floor(900 / 192)


def test_short_chunks_are_refused_and_no_rows_give_none(spark, feed):
    with pytest.raises(Exception, match="chunks of 30 hours"):
        W.sequences(W.sequence_chunks(feed, ["load"], 29), 24, 6, past=["load"], target=["load"]).collect()
    assert W.sequences(W.sequence_chunks(feed.limit(0), ["load"], 30), 24, 6, past=["load"], target=["load"]).isEmpty()


def test_three_exchanges(spark, feed, tmp_path):
    """One by hour, which combines first, one by chunk, one for the chunk after; windows are cut behind the last."""
    feed.write.parquet(str(tmp_path / "feed"))
    stored = W.sequence_chunks(spark.read.parquet(str(tmp_path / "feed")), ["load", "price"], 30)
    assert stored._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    stored.write.parquet(str(tmp_path / "chunks"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = W.sequences(spark.read.parquet(str(tmp_path / "chunks")), 24, 6, past=["load"], target=["price"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan
