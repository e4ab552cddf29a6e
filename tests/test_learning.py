"""Preparation, metrics, ensembles and models: no leakage, edge cases, invariants."""

import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from hourweave.operators import boosting as B
from hourweave.operators import ensemble as E
from hourweave.operators import metrics as X
from hourweave.operators import models as M
from hourweave.operators import prep
from hourweave.operators import quality as Q
from hourweave.plans import catalog
from hourweave.plans.dataset import prepare
from hourweave.session import materialise
from hourweave.sources import sinks
from tests.compare import difference

PREDICTIONS = "TimestampHour int, SettlementPoint string, split string, model string, y double, prediction double"


@pytest.fixture(scope="module")
def features(spark, hour):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        x = float(rng.normal())
        rows.append((hour(i // 4), f"k{i % 4}", 30 + 5 * x, 30 - 20 * (i % 4) + float(rng.normal()), x, 7.0, None if i % 9 == 0 else float(i)))
    return spark.createDataFrame(
        rows, "TimestampHour timestamp_ntz, SettlementPoint string, DAM_Price_Hourly double, RTM_LMP_HourlyAvg double, x double, flat double, gappy double"
    )


@pytest.fixture(scope="module")
def prepared(features):
    data, fitted = prepare(features)
    return materialise(data.withColumnsRenamed({"SettlementPoint": "encoded", "entity": "SettlementPoint"})), fitted


COLUMNS = ["encoded", "x", "flat", "gappy"]


def test_roles(spark, features):
    roles = prep.feature_roles(features)
    assert (roles.categorical, roles.continuous) == (("SettlementPoint",), ("x", "flat", "gappy"))
    numeric = spark.createDataFrame([(1, 2, 3)], "Zone int, other int, DART int")
    assert prep.feature_roles(numeric).categorical == ("Zone",)


@pytest.mark.parametrize(
    ("columns", "target"),
    [(["DART", "RTM_LMP_HourlyAvg"], "RTM_LMP_HourlyAvg"), (["DART", "x_lmp", "LMP_Price"], "LMP_Price"), (["LMP_SPP", "target_price"], "target_price")],
)
def test_target_by_name(columns, target):
    assert prep.infer_target(columns) == target


def test_no_target():
    with pytest.raises(ValueError):
        prep.infer_target(["a", "DART"])


def test_numeric_features_need_a_full_target(spark):
    df = spark.createDataFrame([(1, "a", 2.0, None)], "x int, k string, t double, u double")
    assert prep.numeric_features(df, "t") == ["x", "u"]
    with pytest.raises(ValueError, match="nulls"):
        prep.numeric_features(df, "u")


def test_parameters_ignore_later_rows(features):
    """Changing validation and test rows must not change what is fitted."""
    _, fitted = prepare(features)
    shifted = features.withColumn("x", F.when(F.col("gappy") >= 330, F.lit(1e6)).otherwise(F.col("x"))).withColumn(
        "RTM_LMP_HourlyAvg", F.when(F.col("gappy") >= 330, F.lit(-1e6)).otherwise(F.col("RTM_LMP_HourlyAvg"))
    )
    _, again = prepare(shifted)
    for a, b in ((fitted.encodings, again.encodings), (fitted.scaling, again.scaling)):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_scaling(prepared):
    data, fitted = prepared
    row = prep.train_rows(data).agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"), F.max("flat").alias("f")).first()
    assert (row.m, row.s, row.f) == (pytest.approx(0, abs=1e-9), pytest.approx(1), 0.0)
    assert fitted.scaling.filter("feature = 'flat'").first()["std"] == 1.0


def test_encoding_of_unseen_and_rare(spark):
    train = spark.createDataFrame([("a", 10.0)] * 40 + [("b", 100.0)] + [(None, 0.0)], "k string, DART double")
    params = prep.target_encode_fit(train, ["k"])
    prior = 500 / 42
    rows = {r.key: r.k for r in prep.target_encode_apply(spark.createDataFrame([("a", "a"), ("b", "b"), ("z", "z"), ("null", None)], "key string, k string"), params, ["k"]).collect()}
    weight = 1 / (1 + math.exp(20 - 1))
    assert rows["a"] == pytest.approx(10.0, abs=1e-6)
    assert rows["b"] == pytest.approx(weight * 100 + (1 - weight) * prior)
    assert rows["z"] == rows["null"] == pytest.approx(prior)


def test_scoring_aligns_and_round_trips(spark, features, prepared, tmp_path):
    _, fitted = prepared
    path = str(tmp_path / "fitted")
    sinks.save_fitted(path, {"scaling": fitted.scaling, "encodings": fitted.encodings})
    loaded = type(fitted)(fitted.roles, sinks.load_params(spark, path, "encodings"), sinks.load_params(spark, path, "scaling"))
    rows = features.drop("gappy")
    a, b = (f.score_input(rows).orderBy("TimestampHour", "SettlementPoint", "x") for f in (fitted, loaded))
    assert a.columns == ["TimestampHour", "SettlementPoint", "x", "flat", "gappy"]
    assert a.collect() == b.collect()
    assert fitted.score_input(rows.drop("SettlementPoint")).select("SettlementPoint").distinct().count() == 1


def test_regression_metrics_against_numpy(spark):
    rng = np.random.default_rng(2)
    y, p = rng.normal(size=200) + 1e6, rng.normal(size=200) + 1e6
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, prediction double")
    row = X.regression_metrics(df).first()
    assert row.rmse == pytest.approx(math.sqrt(np.mean((y - p) ** 2)))
    assert row.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2), rel=1e-6)
    assert row.mape == pytest.approx(np.mean(np.abs((y - p) / (np.abs(y) + 1e-10))) * 100)


def test_mape_of_zeros(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, prediction double")
    assert X.mape_masked(df).first().mape_masked == 50.0
    assert X.regression_metrics(df).first().mape > 1e10


def test_classes_with_gaps(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 2), (2, 2)], "y int, prediction int")
    counts = X.confusion_counts(df)
    report = {r.label: (r.precision, r.recall, r.support) for r in X.class_report(counts).collect()}
    assert report == {0: (1.0, 0.5, 2), 1: (0.0, 0.0, 0), 2: (1.0, 1.0, 2)}
    row = X.classification_metrics(counts).first()
    assert (row.accuracy, row.f1_macro, row.f1_weighted) == (0.75, pytest.approx((2 / 3 + 0 + 1) / 3), pytest.approx((2 / 3 * 2 + 2) / 4))
    matrix = {(r.actual, r.predicted): r.n_rows for r in X.confusion_matrix(df, 3).collect()}
    assert len(matrix) == 9 and matrix[0, 1] == 1 and matrix[1, 1] == 0


def test_intervals(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0, 3.0), (9.0, 5.0, 4.0, 3.0)], "y double, p10 double, p50 double, p90 double")
    row = X.quantile_metrics(df).first()
    assert (row.coverage_80, row.quantile_violations, row.quantile_violations_pct) == (0.5, 2, 50.0)
    assert row.calibration == "under_coverage"
    assert X.pinball_loss(df, {"p90": 0.9}).first().quantile_loss_p90 == pytest.approx((0.1 * 2 + 0.9 * 6) / 2)


def _predictions(spark, errors):
    return spark.createDataFrame(
        [(i, "a", s, m, float(i), float(i) + e) for m, e in errors.items() for s in ("val", "test") for i in range(4)], PREDICTIONS
    )


def test_weights(spark):
    rows = {r.model: r.weight for r in E.ensemble_weights(_predictions(spark, {"a": 1.0, "b": -3.0})).collect()}
    assert rows == {"a": pytest.approx(0.75), "b": pytest.approx(0.25)}


def test_weights_of_perfect_models(spark):
    rows = {r.model: r.weight for r in E.ensemble_weights(_predictions(spark, {"a": 0.0, "b": 1.0, "c": 0.0})).collect()}
    assert rows == {"a": 0.5, "b": 0.0, "c": 0.5}


def test_weights_need_two_models(spark):
    with pytest.raises(Exception, match="two models"):
        E.ensemble_weights(_predictions(spark, {"a": 1.0})).collect()


def test_plain_mean_and_output(spark):
    predictions = _predictions(spark, {"a": 1.0, "b": -3.0})
    keys = ["TimestampHour", "SettlementPoint"]
    mean = E.ensemble_predict(predictions, keys=keys).filter("split = 'test' AND TimestampHour = 2").first()
    assert mean.prediction == 1.0
    out = E.ensemble_output(predictions, E.ensemble_weights(predictions), ["a", "b"], keys).filter("TimestampHour = 2").first()
    assert (out.ensemble_prediction, out.a_prediction, out.b_val_rmse, out.ensemble_val_rmse) == (2.0, 3.0, 3.0, 0.0)


def test_leaderboard(spark):
    board = spark.createDataFrame([("a", 2.0), ("b", 1.0), ("c", None), ("d", 1.0), ("e", 9.0)], "model string, test_mae double")
    ranked = {r.model: (r.place, r.medal) for r in E.leaderboard_rank(board).collect()}
    assert ranked == {"b": (1, "gold"), "d": (2, "silver"), "a": (3, "bronze"), "e": (4, None), "c": (5, None)}
    assert E.best_model(board).first().model == "b"
    assert E.improvement_vs_baseline(board, 4.0).first().improvement_pct == 75.0
    assert E.best_model(board.filter("model = 'c'")).isEmpty()


def test_quality_checks(spark, features):
    copies = features.unionByName(features.limit(3))
    report = {r.check: r.status for r in Q.validation_report(copies).collect()}
    assert report["duplicates"] == "fail" and report["spread_rows"] == "pass" and report["time_gaps"] == "pass"
    lacking = {r.check: r.status for r in Q.validation_report(features.drop("RTM_LMP_HourlyAvg")).collect()}
    assert lacking["required_columns"] == "fail: RTM_LMP_HourlyAvg" and lacking["rows"] == "pass"
    with pytest.raises(ValueError, match="empty"):
        Q.require_columns(features.limit(0))
    with pytest.raises(ValueError, match="nope"):
        Q.require_columns(features, ["nope"])


def test_drift(spark):
    a = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    assert Q.drift_psi(a, a, "v").first().psi == pytest.approx(0, abs=1e-9)
    assert Q.drift_psi(a, a.withColumn("v", F.col("v") + 500), "v").first().psi > 0.25


def test_models_learn_and_reload(prepared, tmp_path):
    data, _ = prepared
    specs = {"gbt": M.gbt(rounds=8, depth=3), "broken": M.gbt(label="absent", rounds=2), "ridge": M.linear_models(prep.train_rows(data).count())["ridge"]}
    predictions, failures = M.sweep(data, COLUMNS, specs)
    assert set(failures) == {"broken"}
    scores = {(r.model, r.split): r.r2 for r in X.regression_metrics(predictions, by=["model", "split"]).collect()}
    assert scores["gbt", "train"] > 0.5 and scores["ridge", "test"] > 0.5
    model = M.fit(data, COLUMNS, M.gbt(rounds=3, depth=2))
    path = str(tmp_path / "kept")
    sinks.save_fitted(path, {}, model)
    kept = [M.predict(m, data, "m").orderBy("TimestampHour", "SettlementPoint").collect() for m in (model, sinks.load_model(path))]
    assert kept[0] == kept[1]


def _vectors(data, label):
    return M.VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(data).select("features", label, "split")


def test_rounds_stop_by_patience(prepared):
    """The kept rounds are those up to the best validation loss, and no more than the patience were fitted beyond it."""
    data, _ = prepared
    model = M.fit(data, COLUMNS, M.gbt(rounds=200, depth=3, min_leaf=1, step=0.3), patience=5).stages[-1]
    val = _vectors(data.filter("split = 'val'"), "DART")
    losses = model.evaluateEachIteration(val, "squared")
    assert 1 < len(losses) < 200 and min(losses[1:]) == losses[-1] < losses[0]
    stop = B.Stopper(2)
    assert [stop.over(x) for x in (5, 4, 3, 3.5, 3.6)] == [False] * 4 + [True] and stop.best == 3


@pytest.mark.parametrize("write_every", [25, 2])
def test_boosting_equals_a_plain_loop(spark, write_every):
    """500 rows, the same trees on residuals that are kept here."""
    r = random.Random(1)
    rows = [(Vectors.dense(x := r.random(), z := r.random(), r.random()), 3 * x - (z > 0.5) + r.random() / 5, "train" if i < 350 else "val" if i < 430 else "test") for i, _ in enumerate(range(500))]
    df = spark.createDataFrame(rows, ["features", "y", "split"])
    spec = M.gbt("y", rounds=12, depth=3, step=0.4, min_leaf=3, share=1.0).setSubsamplingRate(1.0)
    got = B.fit_boosted(df, spec, patience=3, write_every=write_every).transform(df).select("prediction").toPandas().prediction.to_numpy()
    y, part = np.array([x[1] for x in rows]), np.array([x[2] for x in rows])
    score = np.full(500, y[part == "train"].mean())
    best, kept, losses = score, score, []
    for number in range(12):
        train = spark.createDataFrame([(x[0], float(t)) for x, t in zip(rows, y - score) if x[2] == "train"], ["features", "residual"])
        tree = B.one_tree(spec, spec.getSeed() + number, "residual").fit(train)
        score = score + 0.4 * tree.transform(df).select("prediction").toPandas().prediction.to_numpy()
        losses.append(((y - score)[part == "val"] ** 2).mean())
        if losses[-1] == min(losses):
            best = score
        if number - int(np.argmin(losses)) >= 3:
            break
    assert np.abs(got - best).max() < 1e-9 and np.abs(best - kept).max() > 0.1


def test_boosting_without_validation_fits_all_rounds(spark):
    rows = [(Vectors.dense(float(i)), float(i % 7), "train") for i in range(60)]
    df = spark.createDataFrame(rows, ["features", "y", "split"])
    assert B.fit_boosted(df, M.gbt("y", rounds=3, depth=2, min_leaf=1)).getNumTrees == 4


def test_boosted_classes(spark):
    r = random.Random(3)
    rows = []
    for i in range(400):
        x, z = r.random(), r.random()
        rows.append((Vectors.dense(x, z), 0 if r.random() < 0.1 else 1 + (x > 0.5) + (z > 0.6), "train" if i < 280 else "val"))
    df = spark.createDataFrame(rows, ["features", "k", "split"])
    spec = M.gbt("k", rounds=10, depth=3, step=0.4, min_leaf=2)
    one, more = (B.fit_boosted_classes(df, spec.copy({spec.maxIter: n}), 4, patience=4, write_every=3) for n in (1, 10))
    loss = {}
    for name, model in (("one", one), ("more", more)):
        out = model.transform(df).withColumn("total", F.aggregate("probability", F.lit(0.0), lambda a, x: a + x))
        row = out.agg(F.min("total").alias("a"), F.max("total").alias("b"), F.min("prediction").alias("low"), F.max("prediction").alias("high")).first()
        assert row.a == pytest.approx(1) and row.b == pytest.approx(1) and row.low >= 0 and row.high <= 3
        loss[name] = out.filter("split = 'val'").agg(F.avg(B.log_loss(F.col("probability"), F.col("k").cast("int")))).first()[0]
    assert loss["more"] < loss["one"] < np.log(4)


def test_quantile_forest_of_one_split(spark):
    """One tree of one split: training quantiles of each side, also for rows of other splits."""
    r = random.Random(4)
    rows = [(float(i % 2), r.gauss(100 * (i % 2), 5), "train" if i < 300 else "val") for i in range(400)]
    df = spark.createDataFrame(rows, "x double, DART double, split string")
    forest = RandomForestRegressor(labelCol="DART", featuresCol="features", numTrees=1, bootstrap=False, maxDepth=1)
    got = M.quantile_forest(df, ["x"], forest).select("x", "p10", "p50", "p90").distinct().collect()
    for g in got:
        side = [y for x, y, s in rows if s == "train" and x == g.x]
        assert [g.p10, g.p50, g.p90] == pytest.approx(np.quantile(side, [0.1, 0.5, 0.9]).tolist())
    assert len(got) == 2


def test_quantile_forest_covers(spark):
    r = random.Random(5)
    rows = [(x := r.random(), r.gauss(10 * x, 1 + 3 * x), "train" if i < 3000 else "val") for i, _ in enumerate(range(4000))]
    df = spark.createDataFrame(rows, "x double, DART double, split string")
    out = M.quantile_forest(df, ["x"], RandomForestRegressor(labelCol="DART", featuresCol="features", numTrees=10, maxDepth=5, minInstancesPerNode=50, seed=1))
    val = out.filter("split = 'val'")
    assert abs(X.interval_coverage(val, "p10", "p90", "DART").first().coverage - 0.8) < 0.02
    wide = val.groupBy((F.col("x") > 0.5).alias("high")).agg(F.avg(F.col("p90") - F.col("p10")).alias("w")).collect()
    assert {w.high: w.w for w in wide}[True] > 1.3 * {w.high: w.w for w in wide}[False]


def test_sweep_board(prepared, monkeypatch):
    data, _ = prepared
    specs = {"gbt": M.gbt(rounds=3, depth=2), "absent": M.gbt(label="absent", rounds=2), **M.linear_models(prep.train_rows(data).count())}
    calls = []
    plain = M.fit

    def fit(stored, features, estimator, patience):
        calls.append(estimator)
        if estimator is specs["lasso"] and calls.count(estimator) == 1 or estimator is specs["huber"]:
            raise PySparkException("a job failed")
        return plain(stored, features, estimator, patience)

    monkeypatch.setattr(M, "fit", fit)
    board = {r.model: r for r in M.sweep_board(*M.sweep(data, COLUMNS, specs)).collect()}
    assert set(board) == set(specs) and {m for m, r in board.items() if r.failure} == {"absent", "huber"}
    assert board["huber"].val_mae is None and board["huber"].place is None and calls.count(specs["huber"]) == 2
    ranked = sorted((r for r in board.values() if r.place), key=lambda r: r.place)
    assert [r.val_mae for r in ranked] == sorted(r.val_mae for r in ranked) and [r.place for r in ranked] == [1, 2, 3, 4]


def test_report_goes_on_without_a_column(spark, hour):
    df = spark.createDataFrame([(hour(0), "a", 1.0), (hour(0), "a", 2.0)], "TimestampHour timestamp_ntz, SettlementPoint string, DAM_Price_Hourly double")
    got = {r.check: (r.value, r.status) for r in Q.validation_report(df).collect()}
    assert got["required_columns"] == (1.0, "fail: RTM_LMP_HourlyAvg")
    assert got["rows"][0] == 2 and got["duplicates"][1] == "fail" and "time_gaps" in got and "spread_rows" not in got


def test_regime_probabilities(prepared):
    data, _ = prepared
    labelled = M.with_regime(data)
    model = M.fit(labelled, COLUMNS, M.regime_classifier("logistic"))
    out = M.regime_predictions(model, labelled).withColumn("total", F.aggregate("probability", F.lit(0.0), lambda a, x: a + x))
    row = out.agg(F.min("total").alias("low"), F.max("total").alias("high"), F.max("prediction").alias("p")).first()
    assert (row.low, row.high) == (pytest.approx(1), pytest.approx(1)) and row.p <= 3


def test_intervals_cover(prepared):
    data, _ = prepared
    row = M.normal_interval(data).filter("split = 'train'").agg(F.avg(F.col("DART").between(F.col("lower"), F.col("upper")).cast("double")).alias("c")).first()
    assert row.c > 0.9
    point = M.normal_interval(data).select("split", F.col("DART").alias("y"), "prediction")
    val = M.conformal_interval(point).filter("split = 'val'")
    assert 0.7 < X.interval_coverage(val, "p10", "p90").first().coverage < 0.9


def test_two_stage_subtracts(prepared):
    data, _ = prepared
    out = M.two_stage_group_means(data, ["SettlementPoint"])
    assert out.filter(F.abs(F.col("prediction") - (F.col("da_pred") - F.col("rt_pred"))) > 0).isEmpty()
    assert out.filter("abs(y - DART) > 1e-9").isEmpty()


def test_class_scores_begin_with_the_shares_unchanged(spark):
    """Of one class nothing is lost; of a class of one row the loss on training rows still falls below that of the shares."""
    spec = M.gbt("regime", rounds=2, depth=2, step=0.3, min_leaf=20, share=1.0)
    assemble = VectorAssembler(inputCols=["x"], outputCol="features")
    rows = [(float(i % 50), 1 if i == 7 else 0, "val" if i % 10 == 9 else "train") for i in range(500)]
    for found, expected in (([(x, 2, s) for x, _, s in rows], 0.0), (rows, (449 * math.log(450 / 449) + math.log(450)) / 450)):
        df = assemble.transform(spark.createDataFrame(found, "x double, regime int, split string"))
        out = B.fit_boosted_classes(df, spec, 4, patience=2).transform(df).where("split = 'train'")
        loss = out.agg(F.avg(B.log_loss(F.col("probability"), F.col("regime")))).first()[0]
        assert loss < (expected or 1e-9)


def test_regimes_of_calm_prices_equal_the_sql(spark, tmp_path):
    """Prices whose spread never leaves the first regime."""
    events = pd.read_parquet("/root/testdata/sf0.001/events.parquet")
    events["value"] = 50 + events["value"] % 1
    events.to_parquet(tmp_path / "events.parquet", coerce_timestamps="us")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet')")
    assert difference(catalog.queries()["regime_boosted"](spark, str(tmp_path)), con, catalog.oracle_sql()["regime_boosted"]) is None
