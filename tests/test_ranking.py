"""Splits, samples, positions and quantiles against brute force, with hot keys and copies."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourweave.operators import quantiles as Q
from hourweave.operators import ranking as K
from hourweave.operators import windows as W

PANEL = "TimestampHour timestamp_ntz, SettlementPoint string, v double"


@pytest.fixture(scope="module")
def skewed(spark, hour):
    """Key `hot` has most rows; hours have gaps."""
    rng = np.random.default_rng(7)
    rows = [(hour(int(h)), "hot", float(x)) for h, x in zip(rng.choice(900, 700, replace=False), rng.normal(size=700))]
    rows += [(hour(h * 3), "cold", float(h)) for h in range(40)]
    return spark.createDataFrame(rows, PANEL)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 9, 10, 11, 19, 25])
def test_split_sizes(spark, hour, n):
    df = spark.createDataFrame([(hour(i // 3), f"k{i % 3}", 1.0) for i in range(n)], PANEL)
    got = {r.split: r.n_rows for r in K.split_ranges(K.chronological_split(df)).collect()}
    train, val = int(n * 0.8), int(n * 0.1)
    assert got == {k: v for k, v in {"train": train, "val": val, "test": n - train - val}.items() if v}


def test_split_is_ordered_and_disjoint(skewed):
    rows = K.chronological_split(skewed).collect()
    assert len(rows) == 740
    by = {s: [(r.TimestampHour, r.SettlementPoint) for r in rows if r.split == s] for s in ("train", "val", "test")}
    assert max(by["train"]) < min(by["val"]) and max(by["val"]) < min(by["test"])


@pytest.mark.parametrize("levels", [0, 1, 3])
def test_cuts_equal_a_full_sort(spark, levels):
    """Mixed order columns, few bins, one bucket with most rows, nulls, and keys alike in their first bytes."""
    rng = np.random.default_rng(11)
    names = ["prefix-" + c for c in "abcd"] + ["x", "", None, "é", "zz"]
    rows = [(int(rng.integers(0, 3)) if i % 3 else 1, float(rng.integers(0, 5)), names[rng.integers(0, len(names))], i) for i in range(600)]
    df = spark.createDataFrame(rows, "b int, x double, k string, id int")
    ordered = sorted(((b, x, k is not None, (k or "").encode(), i) for b, x, k, i in rows))
    cuts = [lambda n, p=p: F.lit(p) for p in (1, 17, 300, 301, 599, 600)]
    got = K.cut_points(df, F.col("b"), ["b", "x", "k", "id"], cuts, levels=levels, bins=4).first()
    assert [got[f"c{j}"].id for j in range(6)] == [ordered[p - 1][4] for p in (1, 17, 300, 301, 599, 600)]
    assert [got[f"t{j}"] for j in range(6)] == [1] * 6


def test_split_with_one_hour_holding_most_rows(spark, hour):
    rows = [(hour(0), f"k{i:04d}", 0.0) for i in range(900)] + [(hour(1), "a", 0.0)]
    got = {r.split: r.n_rows for r in K.split_ranges(K.chronological_split(spark.createDataFrame(rows, PANEL))).collect()}
    assert got == {"train": 720, "val": 90, "test": 91}


@pytest.mark.parametrize("copies", [1, 7, 400])
def test_split_of_copies_keeps_every_row(spark, hour, copies):
    rows = [(hour(0), "a", 1.0)] * copies + [(hour(0), "a", 2.0), (hour(1), "b", 3.0), (hour(2), "a", 4.0)]
    df = spark.createDataFrame(rows, PANEL)
    parts = K.chronological_split_copies(df).groupBy("split").count().collect()
    n = len(rows)
    train, val = int(n * 0.8), int(n * 0.1)
    expected = {"train": train, "val": val, "test": n - train - val}
    assert {r["split"]: r["count"] for r in parts} == {k: v for k, v in expected.items() if v}


def test_hash_sample_is_exact_and_stable(skewed):
    sample = K.hash_sample(skewed, 100, ["TimestampHour", "SettlementPoint"])
    again = K.hash_sample(skewed.repartition(5), 100, ["TimestampHour", "SettlementPoint"])
    assert sample.count() == 100
    assert sample.exceptAll(again).isEmpty()
    assert K.hash_sample(skewed, 10_000, ["TimestampHour", "SettlementPoint"]).count() == 740


@pytest.mark.parametrize("segment_rows", [1, 30, 50_000])
def test_segments_equal_whole_windows(skewed, segment_rows):
    whole = Window.partitionBy("SettlementPoint").orderBy("TimestampHour")
    frame = whole.rowsBetween(-23, 0)
    expected = skewed.withColumn("v_lag_24", F.lag("v", 24).over(whole)).withColumn(
        "v_ma_24", F.when(F.count("v").over(frame) == 24, F.avg("v").over(frame))
    )
    lagged = W.lag_features(skewed, "v", (24,), segment_rows=segment_rows)
    assert lagged.exceptAll(expected.drop("v_ma_24")).isEmpty() and lagged.count() == 740
    rolled = W.rolling_stats(skewed, "v", means=(24,), stds=(24,), segment_rows=segment_rows)
    keys = ["TimestampHour", "SettlementPoint"]
    off = rolled.join(expected.select(*keys, F.col("v_ma_24").alias("e")), keys).filter(
        ~(F.round("v_ma_24", 9).eqNullSafe(F.round("e", 9)))
    )
    assert off.isEmpty() and rolled.count() == 740


def test_calendar_lag_sees_gaps(spark, hour):
    df = spark.createDataFrame([(hour(0), "a", 1.0), (hour(1), "a", 2.0), (hour(3), "a", 3.0)], PANEL)
    rows = sorted(W.lag_features_calendar(df, "v", (1, 2)).collect(), key=lambda r: r.TimestampHour)
    assert [(r.v, r.v_lag_1h, r.v_lag_2h) for r in rows] == [(1.0, None, None), (2.0, 1.0, None), (3.0, None, 2.0)]


def test_calendar_lag_keeps_repeated_rows(spark, hour):
    df = spark.createDataFrame([(hour(0), "a", 1.0), (hour(0), "a", 4.0), (hour(1), "a", 2.0), (hour(1), "a", 2.0), (None, "a", 9.0)], PANEL)
    rows = W.lag_features_calendar(df, "v", (1,)).collect()
    assert sorted((r.v, r.v_lag_1h or 0) for r in rows) == [(1.0, 0), (2.0, 4.0), (2.0, 4.0), (4.0, 0), (9.0, 0)]


@pytest.mark.parametrize("nulls", [1, 5, 10])
def test_split_puts_null_times_last(spark, hour, nulls):
    df = spark.createDataFrame([(None if i < nulls else hour(i), f"k{i}", float(i)) for i in range(10)], PANEL)
    for split in (K.chronological_split, K.chronological_split_copies):
        rows = split(df).collect()
        sizes = [sum(r.split == s for r in rows) for s in ("train", "val", "test")]
        assert sizes == [8, 1, 1]
        order = {"train": 0, "val": 1, "test": 2}
        ranked = sorted(rows, key=lambda r: (r.TimestampHour is None, r.TimestampHour or hour(0), r.SettlementPoint))
        assert [order[r.split] for r in ranked] == sorted(order[r.split] for r in rows)


def test_sample_tells_missing_key_parts_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a|", ""), ("a", "|")], "x string, y string")
    assert K.hash_sample(df, 2, ["x", "y"]).count() == 2


def test_sequences_skip_gaps_and_nulls(spark, hour):
    present = [h for h in range(12) if h != 5]
    df = spark.createDataFrame([(hour(h), "a", None if h == 9 else float(h)) for h in present], PANEL)
    rows = W.sequence_windows(df, "v", history=2, horizon=1).collect()
    assert sorted((r.history, r.target) for r in rows) == [
        ([0.0, 1.0], [2.0]), ([1.0, 2.0], [3.0]), ([2.0, 3.0], [4.0]), ([6.0, 7.0], [8.0]),
    ]


def test_gaps_cross_days(spark, hour):
    df = spark.createDataFrame([(hour(h), "a", 0.0) for h in (22, 23, 24, 80)], PANEL)
    gaps = W.time_gaps(df)
    assert sorted((r.TimestampHour, r.gap_seconds) for r in gaps.collect()) == [
        (hour(22), None), (hour(23), 3600), (hour(24), 3600), (hour(80), 56 * 3600),
    ]
    row = W.time_gap_summary(gaps).first()
    assert (row.one_hour_steps, row.longer_gaps) == (2, 1)
    assert [r.previous_ts for r in W.first_gaps(gaps).collect()] == [hour(24)]


@pytest.mark.parametrize("grain", ["DAY", "HOUR", "MINUTE", "SECOND"])
def test_gaps_at_every_grain(spark, hour, grain):
    r = np.random.default_rng(3)
    steps = np.cumsum(r.choice([0, 1, 7, 59, 3600, 200_000], size=400, p=[0.1, 0.3, 0.3, 0.2, 0.08, 0.02])) - 500_000
    rows = [(hour(0) + dt.timedelta(seconds=int(x)), key, 0.0) for key in "ab" for x in steps[ord(key) % 2 :]]
    df = spark.createDataFrame([*rows, (None, "a", 0.0)], PANEL)
    got = W.time_gaps(df, grain=grain).select("SettlementPoint", "TimestampHour", "previous_ts", "gap_seconds")
    w = Window.partitionBy("SettlementPoint").orderBy("TimestampHour")
    whole = df.where("TimestampHour IS NOT NULL").withColumn("previous_ts", F.lag("TimestampHour").over(w))
    gap = F.timestamp_diff("SECOND", F.col("previous_ts"), F.col("TimestampHour"))
    want = whole.select("SettlementPoint", "TimestampHour", "previous_ts", gap.alias("gap_seconds"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_grain_follows_the_fullest_bucket(spark, hour):
    df = spark.createDataFrame([(hour(0) + dt.timedelta(seconds=i * 90), "a", 0.0) for i in range(100)], PANEL)
    assert [W.gap_grain(df, most=n) for n in (100, 99, 39, 1, 0)] == ["DAY", "HOUR", "MINUTE", "MINUTE", "SECOND"]
    assert W.gap_grain(df.limit(0)) == "DAY"


@pytest.mark.parametrize("open_rows", [None, 20, 0])
def test_quantiles_of_skewed_values(spark, open_rows):
    rng = np.random.default_rng(3)
    groups = {
        "copies": np.r_[np.full(500, 4.2), rng.normal(size=300)],
        "outlier": np.r_[rng.normal(size=400), 1e12, -1e12],
        "wide": np.exp(rng.uniform(-600, 600, size=400)) * rng.choice([-1, 1], 400),
        "one": np.array([3.0]),
        "same": np.full(10, -1.5),
        None: np.array([1.0, 2.0, 4.0]),
    }
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("copies", None), ("copies", math.nan), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r.g, r.prob): r.value for r in Q.exact_quantiles(df, ["x"], probs, by=["g"], open_rows=open_rows).collect()}
    for g, xs in groups.items():
        assert [got[g, p] for p in probs] == pytest.approx(list(np.quantile(xs, probs)), rel=1e-12)
    assert ("none", 0.5) not in got
    whole = np.concatenate(list(groups.values()))
    flat = {r.prob: r.value for r in Q.exact_quantiles(df, ["x"], probs, open_rows=open_rows).collect()}
    assert [flat[p] for p in probs] == pytest.approx(list(np.quantile(whole, probs)), rel=1e-12)


def test_copies_of_few_values_are_read_once(spark, monkeypatch):
    """A value that more than `open_rows` rows have needs no further pass; close values need one."""
    passes = []
    monkeypatch.setattr(Q, "materialise", lambda df, label: passes.append(label) or df.cache())
    df = spark.range(1000).select((F.col("id") % 10).cast("double").alias("x"), (1 + (F.col("id") % 4) * 2.0**-30).alias("close"), F.lit(-0.0).alias("zero"))
    got = {r.prob: r.value for r in Q.exact_quantiles(df, ["x"], [0.25, 0.5, 0.999], open_rows=20).collect()}
    assert got == {0.25: 2.0, 0.5: 4.5, 0.999: 9.0} and len(passes) == 1
    got = [r.value for r in Q.exact_quantiles(df, ["close"], [0.5], open_rows=20).collect()]
    assert got == [1 + 1.5 * 2.0**-30] and len(passes) == 3
    assert [str(r.value) for r in Q.exact_quantiles(df, ["zero"], [0.5]).collect()] == ["0.0"]


def test_order_bits_are_those_of_the_double(spark):
    rng = np.random.default_rng(5)
    some = rng.integers(-(1 << 63), (1 << 63) - 1, 3000).view(np.float64)
    edges = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 2.0, 0.5, 1.7976931348623157e308, math.inf, 2.0**52, 1 - 2.0**-53, 4 - 2.0**-50]
    values = [float(x) for x in some if not math.isnan(x)] + edges + [-x for x in edges if x]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in Q.order_bits(df, "v", "code").collect():
        bits = int(np.array(abs(r.v)).view(np.int64))
        assert r.code == (-bits if r.v < 0 else bits), r.v


def test_few_values_are_left_for_the_last_window(spark):
    """Of log-uniform values the first digit leaves less than one in a hundred, so a table is read twice."""
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(float(x),) for x in np.exp(rng.uniform(-40, 40, 20_000))], "x double")
    codes = Q.order_bits(df, "x", "code").groupBy(F.shiftright("code", Q.SHIFTS[0])).count()
    assert codes.agg(F.max("count")).first()[0] < 200


def test_approx_quantiles_shape(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    rows = {r.prob: r.value for r in Q.approx_quantiles(df, ["x"], [0.25, 0.5]).collect()}
    assert rows == {0.25: pytest.approx(250, abs=2), 0.5: pytest.approx(500, abs=2)}


def test_positions_count_from_zero(spark):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(start + dt.timedelta(hours=7 * i), "a", 0.0) for i in range(50)], PANEL)
    rows = K.positions(df, ["SettlementPoint"], ["TimestampHour"], K.daily()).orderBy("TimestampHour").collect()
    assert [r._pos for r in rows] == list(range(50))
