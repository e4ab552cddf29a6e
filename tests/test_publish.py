"""Sinks and streams: round trips, repeatable writes, stream equals batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourweave.operators import prep
from hourweave.plans.features import realtime_prices
from hourweave.session import scratch_path
from hourweave.sources import readers, sinks
from hourweave.sources.schemas import PREDICTIONS
from hourweave.streaming import incremental as I


@pytest.fixture(scope="module")
def scored(spark, hour):
    rows = [(hour(h), k, float(h)) for h in range(30) for k in ("a", "b")]
    return sinks.prediction_rows(spark.createDataFrame(rows, "TimestampHour timestamp_ntz, SettlementPoint string, prediction double"))


def test_prediction_rows_defaults(spark, hour, scored):
    assert [(f.name, f.dataType) for f in scored.schema] == [(f.name, f.dataType) for f in PREDICTIONS]
    row = sinks.prediction_rows(spark.createDataFrame([(hour(0), 1.0)], "TimestampHour timestamp_ntz, prediction double")).first()
    assert (row.SettlementPoint, row.ModelType) == ("SYSTEM", "gbt")


def test_ordered_parquet(spark, scored, tmp_path):
    path = str(tmp_path / "ordered")
    sinks.write_ordered(scored.orderBy(F.rand(1)), path)
    assert readers.read_parquet(spark, path).exceptAll(scored).isEmpty()
    spans = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min("TimestampHour").alias("a"), F.max("TimestampHour").alias("b")).orderBy("f").collect()
    assert all(x.b <= y.a for x, y in zip(spans, spans[1:]))
    assert all(".snappy." in r.f for r in spans)


def test_publishing_twice_changes_nothing(spark, hour, scored, tmp_path):
    path = str(tmp_path / "published")
    sinks.publish_partitions(scored, path)
    sinks.publish_partitions(scored, path)
    assert spark.read.parquet(path).count() == 60
    late = scored.filter(F.col("TimestampHour") == hour(3)).withColumn("DART_Prediction", F.lit(-1.0))
    sinks.publish_partitions(late, path)
    again = spark.read.parquet(path)
    assert again.count() == 60 and again.filter("DART_Prediction = -1").count() == 2
    assert again.filter("year = 2024 AND month = 1 AND day = 2").count() == 12


def test_append_table(spark, scored):
    sinks.append_table(scored, "predictions_log")
    sinks.append_table(scored, "predictions_log")
    assert spark.table("predictions_log").count() == 120
    assert readers.Market("m", {"rtm": "predictions_log"}).read(spark, "rtm").count() == 120


def test_condition_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "doubles")
    spark.createDataFrame([(1.0,), (5.0,), (float("nan"),), (None,)], "x double").write.parquet(path)
    rows = readers.read_parquet(spark, path, where=F.col("x") > 2)
    assert [r.x for r in rows.collect()] == [5.0]
    assert "GreaterThan(x,2.0)" in rows._jdf.queryExecution().executedPlan().toString()


def test_csv(spark, scored, tmp_path):
    sinks.write_csv(scored, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == scored.columns


def test_nested_roots(spark, scored, tmp_path):
    for part in ("one/x", "two"):
        scored.write.parquet(str(tmp_path / part))
    found = readers.read_parquet(spark, [str(tmp_path / "one"), str(tmp_path / "two")], recursive=True, pattern="*.parquet")
    assert found.count() == 120


@pytest.fixture(scope="module")
def feed(spark, hour, tmp_path_factory):
    """Three files in time order; the last closes all hours before it."""
    path = tmp_path_factory.mktemp("feed")
    schema = "SCEDTimestamp timestamp_ntz, SettlementPoint string, LMP double"
    for i, hours in enumerate((range(0, 4), range(4, 8), range(8, 11))):
        rows = [(hour(h) + dt.timedelta(minutes=m), k, float(h * 60 + m)) for h in hours for m in range(0, 60, 5) for k in ("a", "b")]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path / f"part={i}"))
    return str(path), spark.read.parquet(str(path)).drop("part")


def _stream(spark, feed):
    return I.read_feed(spark, f"{feed[0]}/part=*", feed[1].schema, files_per_batch=1)


def test_stream_equals_batch(spark, hour, feed):
    out = scratch_path(spark, "out")
    I.run_to_table(I.hourly_mean_stream(_stream(spark, feed), "SCEDTimestamp", "LMP", "RTM_LMP_HourlyAvg"), out, scratch_path(spark, "state")).awaitTermination()
    closed = realtime_prices(feed[1]).filter(F.col("TimestampHour") < hour(10))
    got = spark.read.parquet(out)
    assert got.count() == 20 and got.exceptAll(closed.select(got.columns)).isEmpty()


def test_stream_scores_and_publishes_once(spark, hour, feed):
    params = prep.target_encode_fit(spark.createDataFrame([("a", 3.0)] * 200 + [("b", 5.0)] * 200, "SettlementPoint string, DART double"), ["SettlementPoint"])
    stored = scratch_path(spark, "params")
    params.write.parquet(stored)
    static = spark.read.parquet(stored)

    def score(df):
        encoded = prep.target_encode_apply(df.withColumn("key", F.col("SettlementPoint")), static, ["SettlementPoint"])
        return sinks.prediction_rows(encoded.withColumnsRenamed({"SettlementPoint": "prediction", "key": "SettlementPoint"}), model_type="mean")

    path = scratch_path(spark, "published")
    for state in ("first", "replay"):
        hourly = I.hourly_mean_stream(_stream(spark, feed), "SCEDTimestamp", "LMP", "RTM_LMP_HourlyAvg")
        I.publish_stream(score(hourly), path, scratch_path(spark, state)).awaitTermination()
    got = spark.read.parquet(path)
    assert got.count() == 20
    values = {r.SettlementPoint: r.v for r in got.groupBy("SettlementPoint").agg(F.avg("DART_Prediction").alias("v")).collect()}
    assert values == {"a": pytest.approx(3.0), "b": pytest.approx(5.0)}
