"""Bundles are whole or unseen; streams score with them and a repeated batch changes nothing."""

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from hourweave.operators import metrics as X
from hourweave.operators import models as M
from hourweave.plans import bundle as B
from hourweave.plans.dataset import prepare
from hourweave.session import materialise, scratch_path
from hourweave.streaming import incremental as I

FEATURES = "TimestampHour timestamp_ntz, SettlementPoint string, DAM_Price_Hourly double, RTM_LMP_HourlyAvg double, x double"


@pytest.fixture(scope="module")
def features(spark, hour):
    rows = [(hour(i // 4), f"k{i % 4}", 30.0 + i % 7, 20.0 + 5 * (i % 4), float(i % 11)) for i in range(400)]
    return materialise(spark.createDataFrame(rows, FEATURES))


def save(root, features, version, slope=1.0):
    data, fitted = prepare(features, store=materialise)
    data = materialise(data.withColumnsRenamed({"SettlementPoint": "encoded", "entity": "SettlementPoint"}).withColumn("DART", F.col("DART") * slope))
    model = M.fit(data, ["encoded", "x"], LinearRegression(labelCol="DART", featuresCol="features", solver="normal"))
    scores = X.regression_metrics(M.predict(model, data, "linear"), by=["model", "split"])
    B.save_bundle(root, version, model, fitted, scores, "linear")
    return B.Bundle(version, "linear", model, fitted, scores)


def rows(df):
    return sorted((r.TimestampHour, r.SettlementPoint, round(r.DART_Prediction, 9), r.ModelType) for r in df.collect())


def test_saved_and_loaded(spark, features):
    root = scratch_path(spark, "bundles")
    with pytest.raises(LookupError):
        B.load_bundle(spark, root)
    made = save(root, features, "1")
    loaded = B.load_bundle(spark.newSession(), root)
    assert loaded.fitted.roles == made.fitted.roles and loaded.kind == "linear" and loaded.version == "1"
    assert rows(loaded.score(features)) == rows(made.score(features))
    assert sorted(map(str, loaded.metrics.collect())) == sorted(map(str, made.metrics.collect()))
    # absent features and unknown entities are scored too
    odd = features.limit(5).withColumn("SettlementPoint", F.lit("new")).drop("x")
    assert loaded.score(odd).filter("DART_Prediction IS NULL").isEmpty()


def test_a_broken_save_is_not_seen(spark, features, monkeypatch):
    root = scratch_path(spark, "bundles")
    save(root, features, "1")
    before = rows(B.load_bundle(spark, root).score(features))
    monkeypatch.setattr(B, "_COLUMNS", "no such type")
    with pytest.raises(Exception):
        save(root, features, "2", slope=9.0)
    monkeypatch.undo()
    assert B.versions(spark, root).count() == 1 and rows(B.load_bundle(spark, root).score(features)) == before
    save(root, features, "2", slope=9.0)
    assert B.load_bundle(spark, root).version == "2" and rows(B.load_bundle(spark, root).score(features)) != before
    assert rows(B.load_bundle(spark, root, "1").score(features)) == before


def test_stream_scores_equal_batch_and_replay(spark, features):
    root, feed, path, state = (scratch_path(spark, x) for x in ("bundles", "feed", "scores", "state"))
    made = save(root, features, "1")
    halves = features.randomSplit([0.5, 0.5], 1)
    for half in halves:  # hours are spread over both batches
        half.coalesce(1).write.mode("append").parquet(feed)
    stream = lambda: I.read_feed(spark, feed, features.schema, files_per_batch=1)
    I.score_stream(stream(), root, path, state).awaitTermination()
    want = rows(made.score(features))
    assert rows(I.read_scores(spark, path)) == want
    # all batches once more, after a newer version was saved: they keep theirs
    save(root, features, "2", slope=9.0)
    I.score_stream(stream(), root, path, scratch_path(spark, "state-again")).awaitTermination()
    assert rows(I.read_scores(spark, path)) == want
