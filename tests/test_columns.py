"""Scalar functions on hand-written rows."""

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hourweave.functions import scalar as S
from hourweave.functions import timeutil as TU


def values(df, column):
    return [r[column] for r in df.collect()]


@pytest.mark.parametrize(
    ("label", "number"),
    [("1", 1), ("24", 24), ("7", 7), ("1.0", 1), ("01:00", 1), ("24:00", 24), ("1:00", 1), (" 7 ", 7), (None, None)],
)
def test_hour_ending(spark, label, number):
    df = spark.createDataFrame([(label,)], "he string")
    assert values(df.select(TU.hour_ending("he").alias("n")), "n") == [number]


@pytest.mark.parametrize(("kind", "value"), [("int", 7), ("double", 7.0)])
def test_hour_ending_of_numbers(spark, kind, value):
    df = spark.createDataFrame([(value,)], f"he {kind}")
    assert values(df.select(TU.hour_ending("he").alias("n")), "n") == [7]


def test_hour_ending_junk(spark):
    df = spark.createDataFrame([("x",), ("3",), (None,)], "HourEnding string")
    with pytest.raises(PySparkException):
        df.select(TU.hour_ending("HourEnding")).collect()
    assert values(df.select(TU.hour_ending("HourEnding", strict=False).alias("n")), "n") == [None, 3, None]
    assert values(TU.reject_hour_ending(df), "HourEnding") == ["x"]


def test_operday_keeps_and_deliverydate_drops_unlabelled(spark):
    day = dt.datetime(2024, 3, 1, 15, 30)
    df = spark.createDataFrame([(day, "24:00"), (day, None)], "DeliveryDate timestamp_ntz, HourEnding string")
    assert values(TU.deliverydate_to_hour(df), "TimestampHour") == [dt.datetime(2024, 3, 1, 23)]
    kept = TU.operday_to_hour(df.withColumn("OperDay", F.to_date("DeliveryDate")))
    assert values(kept, "TimestampHour") == [dt.datetime(2024, 3, 1, 23), None]


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago"])
def test_floor_hour_ignores_session_zone(spark, zone):
    """02:30 on this day does not exist in Chicago."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:34:56.789' AS ts")
        out = df.select(TU.floor_hour("ts").alias("h"))
        assert out.schema["h"].dataType.simpleString() == "timestamp_ntz"
        assert values(out.select(F.col("h").cast("string").alias("h")), "h") == ["2024-03-10 02:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    ("value", "label"),
    [(0.0, 0), (9.999, 0), (10.0, 1), (-10.0, 1), (49.9, 1), (50.0, 2), (99.9, 2), (100.0, 3), (-250.0, 3), (None, None)],
)
def test_regime_edges(spark, value, label):
    df = spark.createDataFrame([(value,)], "x double")
    assert values(df.select(S.regime(F.col("x")).alias("r")), "r") == [label]


def test_nan_is_null_and_skipped_by_means(spark):
    df = S.nan_to_null(spark.createDataFrame([(1.0,), (math.nan,), (None,), (3.0,)], "x double"))
    row = df.agg(F.avg("x").alias("m"), F.count("x").alias("n")).first()
    assert (row.m, row.n) == (2.0, 2)


def test_spread_needs_both_prices(spark):
    df = spark.createDataFrame(
        [(30.0, 20.0), (None, 1.0), (1.0, None)], "DAM_Price_Hourly double, RTM_LMP_HourlyAvg double"
    )
    assert values(S.spread(df), "DART") == [10.0]
    with pytest.raises(ValueError, match="RTM_LMP_HourlyAvg"):
        S.spread(df.drop("RTM_LMP_HourlyAvg"))


def test_clip_and_ratio(spark):
    df = spark.createDataFrame([(-5.0, -1.0), (200.0, 1.0), (None, 3.0)], "a double, b double")
    rows = df.select(S.clip(F.col("a"), 0, 150).alias("c"), S.guarded_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [tuple(r) for r in rows] == [(0.0, None), (150.0, 100.0), (None, None)]


def test_align_features(spark):
    df = spark.createDataFrame([("a", 1, None)], "k string, x int, y double")
    out = S.align_features(df, ["y", "z", "X"], keep=["k"])
    assert out.columns == ["k", "y", "z", "X"]
    assert tuple(out.first()) == ("a", 0.0, 0.0, 1.0)
    assert S.missing_features(df, ["y", "z", "X"]) == ["z"]


def test_rename_select_is_case_insensitive_and_tolerant(spark):
    df = spark.createDataFrame([(1, 2)], "scedtimestamp int, other int")
    assert S.rename_select(df, {"SCEDTimeStamp": "t", "Absent": "u"}).columns == ["t"]


def test_calendar(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-06 13:00:00' AS TimestampHour")
    row = TU.cyclic_features(TU.calendar_features(df)).first()
    assert (row.Hour, row.DayOfWeek, row.Month, row.Quarter, row.IsWeekend) == (13, 5, 1, 1, 1)
    assert row.hour_sin == pytest.approx(math.sin(2 * math.pi * 13 / 24))
