"""Queries over preparation, metrics, models, ensembles and streams.

Model queries fit the library's default sizes on all rows and return what must hold of any
correct fit, which SQL can state: a prediction for each row, inside the training range for
averages of training rows, better than the training mean on training rows, probabilities and
importances that sum to 1.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourweave.functions import scalar as S
from hourweave.functions.timeutil import HOUR, KEY
from hourweave.operators import boosting as B
from hourweave.operators import ensemble as E
from hourweave.operators import metrics as X
from hourweave.operators import models as M
from hourweave.operators import pinball as P
from hourweave.operators import prep
from hourweave.operators.quantiles import exact_quantiles, quantile_columns
from hourweave.plans.bindings import Tables
from hourweave.plans.bundle import load_bundle, save_bundle
from hourweave.plans.dataset import Fitted, prepare
from hourweave.plans.oracle import CONTINUOUS, rounded, rounded_all
from hourweave.plans.registry import query
from hourweave.session import materialise, scratch_path
from hourweave.sources.sinks import prediction_rows
from hourweave.streaming import incremental as I

GRAIN = "TimestampHour, SettlementPoint"
MODELS = ("previous", "day_back", "key_mean")
METRICS = ("rmse", "mae", "mape", "r2")


def _naive(t: Tables) -> DataFrame:
    return M.naive_predictions(t.split)


def _stored_naive(t: Tables) -> DataFrame:
    """For queries that go over the predictions more than once."""
    return materialise(_naive(t), "predictions")


def _regimes(t: Tables) -> DataFrame:
    return _naive(t).withColumns({"y": S.regime(F.col("y")), "prediction": S.regime(F.col("prediction"))})


def _board(t: Tables) -> DataFrame:
    scores = E.sweep_metrics(_naive(t))
    jobs = t.spark.createDataFrame([(m,) for m in (*MODELS, "pending_model")], "model string")
    return E.leaderboard_join(jobs, scores)


def _test_intervals(t: Tables) -> DataFrame:
    rows = M.quantile_by_group(t.split).filter(F.col("split") == "test").withColumnRenamed(S.SPREAD, "y")
    return materialise(rows.select(HOUR, KEY, "y", *M.QUANTILES.values()), "intervals")


def _prepared(t: Tables) -> tuple[DataFrame, Fitted]:
    """Prepared rows, written once: the fits below read them many times."""
    data, fitted = prepare(t.unified_table, store=materialise)
    keys = data.withColumnsRenamed({KEY: "encoded", "entity": KEY})
    return materialise(keys, "prepared"), fitted


def _features(fitted: Fitted) -> list[str]:
    return ["encoded", *fitted.roles.continuous]


# preparation -----------------------------------------------------------------------


@query("standardize_fit", f"SELECT feature, {rounded_all(['mean', 'std'])} FROM scaling")
def standardize_fit(t: Tables) -> DataFrame:
    return prepare(t.unified_table, store=materialise)[1].scaling


SCALED = ", ".join(
    rounded(f"(coalesce({c}, 0) - (SELECT mean FROM scaling WHERE feature = '{c}')) / (SELECT std FROM scaling WHERE feature = '{c}')", c)
    for c in CONTINUOUS
)


@query("standardize", f"SELECT {GRAIN}, {SCALED} FROM unified_split")
def standardize(t: Tables) -> DataFrame:
    data, fitted = prepare(t.unified_table, store=materialise)
    return data.select(HOUR, F.col("entity").alias(KEY), *fitted.roles.continuous)


@query(
    "target_encode_fit",
    f"""SELECT 'SettlementPoint' AS feature, category, n, {rounded('encoding', 'encoding')} FROM encoding
        UNION ALL SELECT 'SettlementPoint', NULL, count(*), round(avg(DART), 6) FROM train""",
)
def target_encode_fit(t: Tables) -> DataFrame:
    return prep.target_encode_fit(prep.train_rows(t.split), [KEY])


@query(
    "target_encode_apply",
    f"""SELECT TimestampHour, u.SettlementPoint AS entity, round(coalesce(e.encoding, (SELECT avg(DART) FROM train)), 6) AS SettlementPoint
        FROM panel AS u LEFT JOIN encoding AS e ON u.SettlementPoint = e.category""",
)
def target_encode_apply(t: Tables) -> DataFrame:
    params = prep.target_encode_fit(prep.train_rows(t.split), [KEY])
    return prep.target_encode_apply(t.panel.select(HOUR, KEY, F.col(KEY).alias("entity")), params, [KEY])


@query(
    "prepared_dataset",
    f"""SELECT TimestampHour, u.SettlementPoint AS entity, split, {rounded('DART', 'DART')},
          round(coalesce(e.encoding, (SELECT avg(DART) FROM train)), 6) AS SettlementPoint, {SCALED}
        FROM unified_split AS u LEFT JOIN encoding AS e ON u.SettlementPoint = e.category""",
)
def prepared_dataset(t: Tables) -> DataFrame:
    data, fitted = prepare(t.unified_table, store=materialise)
    return data.select(HOUR, "entity", "split", S.SPREAD, *fitted.roles.features)


@query(
    "batch_scores",
    """SELECT TimestampHour, u.SettlementPoint, round(f.a + f.b * coalesce(e.encoding, f.m), 4) AS DART_Prediction, 'linear' AS ModelType
       FROM unified AS u LEFT JOIN encoding AS e ON u.SettlementPoint = e.category, (
         SELECT regr_intercept(DART, coalesce(encoding, m)) AS a, regr_slope(DART, coalesce(encoding, m)) AS b, max(m) AS m
         FROM (SELECT DART, encoding, (SELECT avg(DART) FROM train) AS m FROM train LEFT JOIN encoding ON SettlementPoint = category) AS x) AS f""",
)
def batch_scores(t: Tables) -> DataFrame:
    """A fitted model applied to rows that are first brought to the fitted columns."""
    data, fitted = _prepared(t)
    model = M.fit(data, ["encoded"], LinearRegression(labelCol=S.SPREAD, featuresCol="features", solver="normal"))
    rows = t.unified_table.withColumn("entity", F.col(KEY))
    ready = fitted.score_input(rows, keep=(HOUR, "entity")).withColumnsRenamed({KEY: "encoded", "entity": KEY})
    scored = prediction_rows(model.transform(ready), model_type="linear")
    return scored.withColumn("DART_Prediction", F.round("DART_Prediction", 4))


def _linear_bundle(t: Tables) -> str:
    """Root of a store that holds one saved version."""
    data, fitted = _prepared(t)
    model = M.fit(data, ["encoded"], LinearRegression(labelCol=S.SPREAD, featuresCol="features", solver="normal"))
    root = scratch_path(t.spark, "bundles")
    save_bundle(root, "1", model, fitted, X.regression_metrics(M.predict(model, data, "linear"), by=["model", "split"]), "linear")
    return root


SCORES_SQL = """SELECT TimestampHour, u.SettlementPoint, round(f.a + f.b * coalesce(e.encoding, f.m), 4) AS DART_Prediction, 'linear' AS ModelType
       FROM unified AS u LEFT JOIN encoding AS e ON u.SettlementPoint = e.category, (
         SELECT regr_intercept(DART, coalesce(encoding, m)) AS a, regr_slope(DART, coalesce(encoding, m)) AS b, max(m) AS m
         FROM (SELECT DART, encoding, (SELECT avg(DART) FROM train) AS m FROM train LEFT JOIN encoding ON SettlementPoint = category) AS x) AS f"""


@query("fitted_bundle", SCORES_SQL)
def fitted_bundle(t: Tables) -> DataFrame:
    """Model, columns and parameters saved as one version and loaded again score as they did."""
    bundle = load_bundle(t.spark, _linear_bundle(t))
    return bundle.score(t.unified_table).withColumn("DART_Prediction", F.round("DART_Prediction", 4))


@query("stream_scores", SCORES_SQL)
def stream_scores(t: Tables) -> DataFrame:
    """The feature rows as a stream, scored and published by a saved bundle."""
    root, feed, path = _linear_bundle(t), scratch_path(t.spark, "score-feed"), scratch_path(t.spark, "scores")
    t.unified_table.write.parquet(feed)
    rows = I.read_feed(t.spark, feed, t.unified_table.schema)
    I.score_stream(rows, root, path, scratch_path(t.spark, "score-state")).awaitTermination()
    return I.read_scores(t.spark, path).withColumn("DART_Prediction", F.round("DART_Prediction", 4))


# metrics ---------------------------------------------------------------------------


@query("naive_predictions", f"SELECT {GRAIN}, split, model, {rounded_all(['y', 'prediction'])} FROM naive")
def naive_predictions(t: Tables) -> DataFrame:
    return _naive(t)


@query("regression_metrics", f"SELECT model, split, n_rows, {rounded_all(METRICS)} FROM scores")
def regression_metrics(t: Tables) -> DataFrame:
    return X.regression_metrics(_naive(t), by=["model", "split"])


@query(
    "mape_masked",
    "SELECT model, round(avg(CASE WHEN y <> 0 THEN abs((y - prediction) / y) END) * 100, 6) AS mape_masked FROM naive GROUP BY 1",
)
def mape_masked(t: Tables) -> DataFrame:
    return X.mape_masked(_naive(t), by=["model"])


@query(
    "confusion_matrix",
    """SELECT m.model, CAST(a.l AS BIGINT) AS actual, CAST(p.l AS BIGINT) AS predicted, count(r.actual) AS n_rows
       FROM (SELECT DISTINCT model FROM regimes) AS m CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS l) AS a CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS l) AS p
       LEFT JOIN regimes AS r ON r.model = m.model AND r.actual = a.l AND r.predicted = p.l GROUP BY 1, 2, 3""",
)
def confusion_matrix(t: Tables) -> DataFrame:
    return X.confusion_matrix(_regimes(t), by=["model"])


@query(
    "classification_metrics",
    """SELECT model, CAST(sum(support) AS BIGINT) AS n_rows, round(sum(tp) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS f1_macro,
         round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM class_rows GROUP BY 1""",
)
def classification_metrics(t: Tables) -> DataFrame:
    return X.classification_metrics(X.confusion_counts(_regimes(t), by=["model"]), by=["model"])


@query(
    "class_report",
    """SELECT model, CAST(label AS BIGINT) AS label, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1,
         CAST(support AS BIGINT) AS support FROM class_rows""",
)
def class_report(t: Tables) -> DataFrame:
    return X.class_report(X.confusion_counts(_regimes(t), by=["model"]), by=["model"]).drop("tp")


@query("quantile_by_group", f"SELECT {GRAIN}, split, {rounded_all(['y', 'p10', 'p50', 'p90'])} FROM intervals")
def quantile_by_group(t: Tables) -> DataFrame:
    return M.quantile_by_group(t.split).select(HOUR, KEY, "split", F.col(S.SPREAD).alias("y"), "p10", "p50", "p90")


@query(
    "interval_coverage",
    "SELECT SettlementPoint, count(*) AS n_rows, round(avg(CASE WHEN y BETWEEN p10 AND p90 THEN 1.0 ELSE 0.0 END), 6) AS coverage "
    "FROM test_intervals GROUP BY 1",
)
def interval_coverage(t: Tables) -> DataFrame:
    return X.interval_coverage(_test_intervals(t), "p10", "p90", by=[KEY])


@query(
    "interval_width",
    """SELECT round(avg(p90 - p10), 6) AS mean_width, round(stddev_pop(p90 - p10), 6) AS std_width, round(min(p90 - p10), 6) AS min_width,
         round(max(p90 - p10), 6) AS max_width, round(quantile_cont(p90 - p10, 0.5), 6) AS median_width FROM test_intervals""",
)
def interval_width(t: Tables) -> DataFrame:
    return X.interval_width(_test_intervals(t), "p10", "p90")


def _pinball_sql(column: str, alpha: float) -> str:
    return f"avg(CASE WHEN y >= {column} THEN (y - {column}) * {alpha} ELSE (y - {column}) * ({alpha} - 1) END)"


LOSSES = ", ".join(rounded(_pinball_sql(c, a), f"quantile_loss_{c}") for c, a in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)))
CROSSED = "count(*) FILTER (WHERE p10 > p50) + count(*) FILTER (WHERE p50 > p90)"


@query("pinball_loss", f"SELECT SettlementPoint, {LOSSES} FROM test_intervals GROUP BY 1")
def pinball_loss(t: Tables) -> DataFrame:
    return X.pinball_loss(_test_intervals(t), {"p10": 0.1, "p50": 0.5, "p90": 0.9}, by=[KEY])


@query(
    "quantile_crossing",
    f"""SELECT model, SettlementPoint, {CROSSED} AS quantile_violations, round(({CROSSED}) * CAST(100 AS DOUBLE) / (2 * count(*)), 6)
        AS quantile_violations_pct FROM (
          SELECT model, SettlementPoint, prediction - 5 AS p10, prediction AS p50, y AS p90 FROM naive) AS a GROUP BY 1, 2""",
)
def quantile_crossing(t: Tables) -> DataFrame:
    rows = _naive(t).select("model", KEY, (F.col("prediction") - 5).alias("p10"), F.col("prediction").alias("p50"), F.col("y").alias("p90"))
    return X.quantile_crossing(rows, by=["model", KEY])


@query(
    "quantile_metrics",
    f"""SELECT *, CASE WHEN abs(coverage_80 - 0.8) * 100 < 2 THEN 'excellent' WHEN abs(coverage_80 - 0.8) * 100 < 5 THEN 'good'
          WHEN coverage_80 < 0.8 THEN 'under_coverage' ELSE 'over_coverage' END AS calibration FROM (
          SELECT round(avg(abs(y - p50)), 6) AS mae_p50, round(sqrt(avg(power(y - p50, 2))), 6) AS rmse_p50,
            round(1 - sum(power(y - p50, 2)) / sum(power(y - m, 2)), 6) AS r2_p50,
            round(avg(CASE WHEN y BETWEEN p10 AND p90 THEN 1.0 ELSE 0.0 END), 6) AS coverage_80,
            round(avg(p90 - p10), 6) AS interval_mean_width, round(quantile_cont(p90 - p10, 0.5), 6) AS interval_median_width, {LOSSES},
            {CROSSED} AS quantile_violations, round(({CROSSED}) * CAST(100 AS DOUBLE) / (2 * count(*)), 6) AS quantile_violations_pct
          FROM (SELECT *, avg(y) OVER () AS m FROM test_intervals) AS a) AS b""",
)
def quantile_metrics(t: Tables) -> DataFrame:
    return X.quantile_metrics(_test_intervals(t))


BAND = """CASE WHEN abs(coverage_80 - 0.8) * 100 < 2 THEN 'excellent' WHEN abs(coverage_80 - 0.8) * 100 < 5 THEN 'good'
          WHEN coverage_80 < 0.8 THEN 'under_coverage' ELSE 'over_coverage' END AS calibration"""


@query(
    "interval_width_by_key",
    """SELECT SettlementPoint, split, round(avg(p90 - p10), 6) AS mean_width, round(stddev_pop(p90 - p10), 6) AS std_width, round(min(p90 - p10), 6) AS min_width,
         round(max(p90 - p10), 6) AS max_width, round(quantile_cont(p90 - p10, 0.5), 6) AS median_width FROM (
           SELECT TimestampHour, SettlementPoint, split, least(y, 5) - 1 AS p10, greatest(y, 7) AS p90 FROM intervals) AS a GROUP BY 1, 2""",
)
def interval_width_by_key(t: Tables) -> DataFrame:
    rows = M.quantile_by_group(t.split).withColumns({"p10": F.least(S.SPREAD, F.lit(5.0)) - 1, "p90": F.greatest(S.SPREAD, F.lit(7.0))})
    return X.interval_width(rows, "p10", "p90", by=[KEY, "split"])


@query(
    "quantile_metrics_by_key",
    f"""SELECT *, {BAND} FROM (
          SELECT SettlementPoint, round(avg(abs(y - p50)), 6) AS mae_p50, round(sqrt(avg(power(y - p50, 2))), 6) AS rmse_p50,
            round(1 - sum(power(y - p50, 2)) / sum(power(y - m, 2)), 6) AS r2_p50,
            round(avg(CASE WHEN y BETWEEN p10 AND p90 THEN 1.0 ELSE 0.0 END), 6) AS coverage_80,
            round(avg(p90 - p10), 6) AS interval_mean_width, round(quantile_cont(p90 - p10, 0.5), 6) AS interval_median_width, {LOSSES},
            {CROSSED} AS quantile_violations, round(({CROSSED}) * CAST(100 AS DOUBLE) / (2 * count(*)), 6) AS quantile_violations_pct
          FROM (SELECT *, avg(y) OVER (PARTITION BY SettlementPoint) AS m FROM test_intervals) AS a GROUP BY 1) AS b""",
)
def quantile_metrics_by_key(t: Tables) -> DataFrame:
    return X.quantile_metrics(_test_intervals(t), by=[KEY])


@query("rmse_alert", f"SELECT model, split, {rounded_all(['rmse'])}, rmse > 10 AS alert FROM scores")
def rmse_alert(t: Tables) -> DataFrame:
    return X.rmse_alert(X.regression_metrics(_naive(t), by=["model", "split"])).select("model", "split", "rmse", "alert")


@query(
    "conformal_interval",
    f"""SELECT {GRAIN}, split, n.model, {rounded_all(['y', 'prediction'])}, {', '.join(f'round(prediction + q.r{p}, 6) AS p{p}' for p in (10, 50, 90))}
        FROM naive AS n LEFT JOIN (SELECT model, {', '.join(f'quantile_cont(y - prediction, 0.{p}) AS r{p}' for p in (10, 50, 90))} FROM naive
          WHERE split = 'val' GROUP BY 1) AS q ON n.model = q.model""",
)
def conformal_interval(t: Tables) -> DataFrame:
    return M.conformal_interval(_stored_naive(t), by=["model"])


@query(
    "normal_interval",
    f"""SELECT s.TimestampHour, s.SettlementPoint, split, {rounded('DART', 'DART')}, {rounded('m', 'prediction')},
          {rounded('m - 1.959964 * sd', '"lower"')}, {rounded('m + 1.959964 * sd', '"upper"')} FROM splits AS s
        LEFT JOIN (SELECT SettlementPoint, avg(DART) AS m, stddev_samp(DART) AS sd FROM train GROUP BY 1) AS f
          ON s.SettlementPoint = f.SettlementPoint""",
)
def normal_interval(t: Tables) -> DataFrame:
    return M.normal_interval(t.split.select(HOUR, KEY, "split", S.SPREAD))


@query(
    "two_stage",
    f"""SELECT {GRAIN}, split, {rounded_all(['da_pred', 'rt_pred'])}, {rounded('DART', 'y')}, {rounded('da_pred - rt_pred', 'prediction')}
        FROM stages""",
)
def two_stage(t: Tables) -> DataFrame:
    data = t.split.withColumn("hour_of_day", F.hour(HOUR))
    return M.two_stage_group_means(data, [KEY, "hour_of_day"]).select(HOUR, KEY, "split", "da_pred", "rt_pred", "y", "prediction")


# leaderboard and ensemble ----------------------------------------------------------

BOARD = ("val_rmse", "val_mae", "test_rmse", "test_mae")


@query("model_sweep_metrics", f"SELECT model, {rounded_all(BOARD)} FROM board")
def model_sweep_metrics(t: Tables) -> DataFrame:
    return E.sweep_metrics(_naive(t)).orderBy("val_mae", "model")


@query("leaderboard_join", f"SELECT model, {rounded_all(BOARD)} FROM joined_board")
def leaderboard_join(t: Tables) -> DataFrame:
    return _board(t)


@query(
    "leaderboard_rank",
    f"""SELECT model, {rounded('test_mae', 'test_mae')}, place, CASE WHEN test_mae IS NULL THEN NULL WHEN place = 1 THEN 'gold'
          WHEN place = 2 THEN 'silver' WHEN place = 3 THEN 'bronze' END AS medal FROM (
          SELECT *, row_number() OVER (ORDER BY test_mae ASC NULLS LAST, model) AS place FROM joined_board) AS a""",
)
def leaderboard_rank(t: Tables) -> DataFrame:
    return E.leaderboard_rank(_board(t)).select("model", "test_mae", "place", "medal")


@query("best_model", "SELECT model, round(test_mae, 6) AS metric FROM board ORDER BY test_mae, model LIMIT 1")
def best_model(t: Tables) -> DataFrame:
    return E.best_model(_board(t))


@query(
    "leaderboard_summary",
    """SELECT count(test_mae) AS n_models, round(min(test_mae), 6) AS best, round(max(test_mae), 6) AS worst, round(avg(test_mae), 6) AS mean,
         round(max(test_mae) - min(test_mae), 6) AS "range" FROM joined_board""",
)
def leaderboard_summary(t: Tables) -> DataFrame:
    return E.leaderboard_summary(_board(t))


@query(
    "improvement_vs_baseline",
    """SELECT model, round(test_mae, 6) AS metric, CAST(40 AS DOUBLE) AS baseline, round(40 - test_mae, 6) AS reduction,
         round((40 - test_mae) / 40 * 100, 6) AS improvement_pct FROM board ORDER BY test_mae, model LIMIT 1""",
)
def improvement_vs_baseline(t: Tables) -> DataFrame:
    return E.improvement_vs_baseline(_board(t), 40.0)


@query("ensemble_weights", f"SELECT model, {rounded_all(['val_rmse', 'weight'])} FROM weights")
def ensemble_weights(t: Tables) -> DataFrame:
    return E.ensemble_weights(_stored_naive(t))


@query("ensemble_predict", f"SELECT {GRAIN}, split, {rounded_all(['y', 'prediction'])} FROM blend")
def ensemble_predict(t: Tables) -> DataFrame:
    predictions = _stored_naive(t)
    return E.ensemble_predict(predictions, E.ensemble_weights(predictions))


@query(
    "ensemble_output",
    f"""SELECT b.TimestampHour, b.SettlementPoint, {rounded('b.y', 'actual')}, {rounded('b.prediction', 'ensemble_prediction')},
          {rounded('(SELECT sqrt(avg(power(y - prediction, 2))) FROM blend WHERE split = $$val$$)', 'ensemble_val_rmse')},
          {', '.join(rounded(f"max(CASE WHEN n.model = '{m}' THEN n.prediction END)", f'{m}_prediction') for m in MODELS)},
          {', '.join(rounded(f"(SELECT val_rmse FROM weights WHERE model = '{m}')", f'{m}_val_rmse') for m in MODELS)}
        FROM blend AS b JOIN naive AS n ON b.TimestampHour = n.TimestampHour AND b.SettlementPoint = n.SettlementPoint
        WHERE b.split = 'test' GROUP BY b.TimestampHour, b.SettlementPoint, b.y, b.prediction""",
)
def ensemble_output(t: Tables) -> DataFrame:
    predictions = _stored_naive(t)
    return E.ensemble_output(predictions, E.ensemble_weights(predictions), MODELS)


# distributed models ----------------------------------------------------------------

PER_SPLIT = "SELECT '{model}' AS model, split, count(*) AS n_rows, count(*) AS n_predicted, {more} FROM unified_split GROUP BY split"
BETTER = "CASE WHEN split = 'train' THEN true END AS better_than_mean"


def _held(predictions: DataFrame) -> DataFrame:
    """Per model and split: rows, rows with a finite prediction, and on training rows whether the mean is beaten."""
    y, p = F.col("y"), F.col("prediction")
    finite = p.isNotNull() & ~F.isnan(p) & (F.abs(p) < 1e300)
    better = F.avg((y - p) ** 2) < F.var_pop(y)
    return predictions.groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(finite, 1)).alias("n_predicted"),
        better.alias("better"),
    ).select("model", "split", "n_rows", "n_predicted", F.when(F.col("split") == "train", F.col("better")).alias("better_than_mean"))


#: Larger steps and less patience than the library's defaults (0.05, 50 rounds, any gain), so that a fit takes some tens of rounds.
BOOSTING = {"step": 0.3}
PATIENCE, GAIN = 6, 0.01


@query("gbt_regression", PER_SPLIT.format(model="gbt", more=BETTER))
def gbt_regression(t: Tables) -> DataFrame:
    data, fitted = _prepared(t)
    model = M.fit(data, _features(fitted), M.gbt(**BOOSTING), PATIENCE, GAIN)
    return _held(M.predict(model, data, "gbt"))


@query("rf_regression", PER_SPLIT.format(model="random_forest", more=f"{BETTER}, count(*) AS n_in_range"))
def rf_regression(t: Tables) -> DataFrame:
    data, fitted = _prepared(t)
    model = M.fit(data, _features(fitted), M.random_forest())
    predictions = M.predict(model, data, "random_forest")
    limits = prep.train_rows(data).agg(F.min(S.SPREAD).alias("low"), F.max(S.SPREAD).alias("high"))
    inside = S.attach_row(predictions, limits, "_r").filter(F.col("prediction").between(F.col("_r.low") - 1e-9, F.col("_r.high") + 1e-9))
    return _held(predictions).join(inside.groupBy("split").agg(F.count(F.lit(1)).alias("n_in_range")), "split")


@query("extra_trees", PER_SPLIT.format(model="extra_trees", more=f"{BETTER}, count(*) AS n_in_range"))
def extra_trees(t: Tables) -> DataFrame:
    data, fitted = _prepared(t)
    predictions = M.predict(M.fit(data, _features(fitted), M.extra_trees(trees=20, depth=6)), data, "extra_trees")
    limits = prep.train_rows(data).agg(F.min(S.SPREAD).alias("low"), F.max(S.SPREAD).alias("high"))
    inside = S.attach_row(predictions, limits, "_r").withColumn("inside", F.col("prediction").between(F.col("_r.low") - 1e-9, F.col("_r.high") + 1e-9))
    counted = inside.groupBy("split").agg(F.count_if("inside").alias("n_in_range"))
    return _held(predictions).join(counted, "split")


@query(
    "linear_regression",
    " UNION ALL ".join(PER_SPLIT.format(model=m, more="true AS known") for m in ("ridge", "lasso", "elastic_net", "huber")),
)
def linear_regression(t: Tables) -> DataFrame:
    data, fitted = _prepared(t)
    predictions, failures = M.sweep(data, _features(fitted), M.linear_models(prep.train_rows(data).count()))
    return _held(predictions).drop("better_than_mean").withColumn("known", F.lit(not failures))


@query(
    "linear_one_feature",
    f"""SELECT {GRAIN}, split, round(regr_intercept + regr_slope * DAM_Price_Hourly, 3) AS prediction FROM splits,
          (SELECT regr_slope(DART, DAM_Price_Hourly) AS regr_slope, regr_intercept(DART, DAM_Price_Hourly) AS regr_intercept FROM train) AS f""",
)
def linear_one_feature(t: Tables) -> DataFrame:
    model = M.fit(t.split, [S.DAM], LinearRegression(labelCol=S.SPREAD, featuresCol="features", solver="normal"))
    return M.predict(model, t.split, "ols").select(HOUR, KEY, "split", F.round("prediction", 3).alias("prediction"))


@query(
    "regime_classifier",
    "SELECT split, count(*) AS n_rows, count(*) AS n_valid, count(*) AS n_sum_to_one FROM unified_split GROUP BY split",
)
def regime_classifier(t: Tables) -> DataFrame:
    data, fitted = _prepared(t)
    labelled = M.with_regime(data)
    model = M.fit(labelled, _features(fitted), M.regime_classifier())
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    return M.regime_predictions(model, labelled).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("prediction").between(0, 3), 1)).alias("n_valid"),
        F.count(F.when(F.abs(total - 1) < 1e-6, 1)).alias("n_sum_to_one"))


SWEPT = ("gbt", "random_forest", "ridge", "lasso", "elastic_net", "huber")


@query(
    "fitted_sweep",
    " UNION ALL ".join(
        f"""SELECT '{m}' AS model, true AS fitted, count(CASE WHEN split = 'val' THEN 1 END) AS n_val, count(CASE WHEN split = 'test' THEN 1 END) AS n_test,
              true AS in_order FROM unified_split""" for m in SWEPT)
    + " UNION ALL SELECT 'unfit', false, NULL, NULL, NULL",
)
def fitted_sweep(t: Tables) -> DataFrame:
    """Six models and one that cannot be fitted, ranked by validation MAE from one grouped pass over their predictions."""
    data, fitted = _prepared(t)
    specs = M.sweep_specs(prep.train_rows(data).count(), rounds=40, step=BOOSTING["step"], trees=20) | {"unfit": M.gbt("no_such_target")}
    predictions, failures = M.sweep(data, _features(fitted), specs, patience=PATIENCE)
    predictions = materialise(predictions, "sweep-predictions")
    board = M.sweep_board(predictions, failures)
    # a model's place against the one before it; the board has one row per model
    before = F.lag("val_mae").over(Window.orderBy(F.col("place").asc_nulls_last()))
    board = board.withColumn("in_order", F.when(F.col("place").isNotNull(), (F.col("val_mae") >= F.coalesce(before, F.lit(0.0)))))
    rows = predictions.groupBy("model").agg(*[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("val", "test")])
    return board.join(rows, "model", "left").select("model", F.col("failure").isNull().alias("fitted"), "n_val", "n_test", "in_order")


@query(
    "quantile_forest",
    "SELECT split, count(*) AS n_rows, count(*) AS n_ordered, CASE WHEN split = 'train' THEN true END AS covers FROM unified_split GROUP BY split",
)
def quantile_forest(t: Tables) -> DataFrame:
    """Quantiles given all features; on training rows p10 to p90 hold at least 80 % of what was seen."""
    data, fitted = _prepared(t)
    out = M.quantile_forest(data, _features(fitted), M.random_forest(trees=20, depth=8, min_leaf=50))
    ordered = (F.col("p10") <= F.col("p50")) & (F.col("p50") <= F.col("p90"))
    inside = F.avg(F.col(S.SPREAD).between(F.col("p10"), F.col("p90")).cast("double"))
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(ordered).alias("n_ordered"), (inside >= 0.75).alias("c")).select(
        "split", "n_rows", "n_ordered", F.when(F.col("split") == "train", F.col("c")).alias("covers"))


@query(
    "quantile_boosting",
    "SELECT split, count(*) AS n_rows, count(*) AS n_predicted, CASE WHEN split = 'train' THEN true END AS beats_start FROM unified_split GROUP BY split",
)
def quantile_boosting(t: Tables) -> DataFrame:
    """Boosted p10, p50 and p90; on training rows their pinball loss is below that of the training quantiles alone."""
    data, fitted = _prepared(t)
    out = M.quantile_boosting(data, _features(fitted), M.gbt(rounds=4, depth=3, **BOOSTING), patience=4)
    start = quantile_columns(exact_quantiles(prep.train_rows(data), [S.SPREAD], list(M.QUANTILES)), M.QUANTILES, ["column"])
    loss = lambda q: sum((P.pinball(p, F.col(S.SPREAD) - q(name)) for p, name in M.QUANTILES.items()), F.lit(0.0))
    both = S.attach_row(out, start, "_s").withColumns({"own": loss(F.col), "plain": loss(lambda name: F.col(f"_s.{name}"))})
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.col("p10") + F.col("p50") + F.col("p90")).alias("n_predicted"), (F.avg("own") < F.avg("plain")).alias("b")
    ).select("split", "n_rows", "n_predicted", F.when(F.col("split") == "train", F.col("b")).alias("beats_start"))


@query(
    "regime_boosted",
    "SELECT split, count(*) AS n_rows, count(*) AS n_valid, count(*) AS n_sum_to_one, CASE WHEN split = 'train' THEN true END AS beats_shares FROM unified_split GROUP BY split",
)
def regime_boosted(t: Tables) -> DataFrame:
    """Softmax boosting of the regimes; on training rows its log loss is below that of the class shares.

    If all training rows have one regime, the shares lose nothing there and the fit must lose nothing either.
    """
    data, fitted = _prepared(t)
    features = _features(fitted)
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(M.with_regime(data))
    model = B.fit_boosted_classes(rows, M.gbt("regime", rounds=8, depth=4, **BOOSTING), 4, patience=4)
    out = materialise(model.transform(rows).select("split", "regime", "probability", "prediction"), "regimes")
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    shares = prep.train_rows(out).groupBy("regime").count().withColumn("p", F.col("count") / F.sum("count").over(Window.partitionBy()))
    entropy = shares.agg((-F.sum(F.col("p") * F.log("p"))).alias("entropy"))
    scored = out.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prediction").between(0, 3)).alias("n_valid"), F.count_if(F.abs(total - 1) < 1e-6).alias("n_sum_to_one"),
        F.avg(B.log_loss(F.col("probability"), F.col("regime"))).alias("loss"))
    beats = F.when(F.col("_e.entropy") == 0, F.col("loss") < 1e-9).otherwise(F.col("loss") < F.col("_e.entropy"))
    return S.attach_row(scored, entropy, "_e").select(
        "split", "n_rows", "n_valid", "n_sum_to_one", F.when(F.col("split") == "train", beats).alias("beats_shares"))


def _stages(t: Tables) -> tuple[DataFrame, Fitted, list]:
    data, fitted = _prepared(t)
    specs = {label: M.gbt(label, **BOOSTING) for label in (S.DAM, S.RTM)}
    fit = lambda label: M.fit(data, _features(fitted), specs[label], PATIENCE, GAIN)
    with ThreadPoolExecutor(len(specs)) as pool:
        return data, fitted, list(pool.map(inheritable_thread_target(t.spark)(fit), specs))


@query(
    "two_stage_gbt",
    " UNION ALL ".join(PER_SPLIT.format(model=m, more="true AS added_up") for m in ("da", "rt", "dart")),
)
def two_stage_gbt(t: Tables) -> DataFrame:
    data, _, (da, rt) = _stages(t)
    first, second = M.predict(da, data, "da", S.DAM), M.predict(rt, data, "rt", S.RTM)
    both = M.two_stage(first, second).withColumn("model", F.lit("dart")).select(first.columns)
    held = _held(first.unionByName(second).unionByName(both)).drop("better_than_mean")
    sums = first.join(second.select(HOUR, KEY, F.col("prediction").alias("rt_pred")), [HOUR, KEY]).join(
        both.select(HOUR, KEY, F.col("prediction").alias("both")), [HOUR, KEY])
    wrong = sums.filter(F.abs(F.col("prediction") - F.col("rt_pred") - F.col("both")) > 1e-9).agg((F.count(F.lit(1)) == 0).alias("ok"))
    return S.attach_row(held, wrong, "_w").withColumn("added_up", F.col("_w.ok")).drop("_w")


@query("feature_importance", f"SELECT {1 + len(CONTINUOUS)} AS n_features, 1 AS total, true AS ordered")
def feature_importance(t: Tables) -> DataFrame:
    _, fitted, stages = _stages(t)
    names = _features(fitted)
    table = M.feature_importance(t.spark, stages, names, k=len(names))
    return table.agg(
        F.count(F.lit(1)).alias("n_features"), F.round(F.sum("importance"), 6).cast("int").alias("total"),
        (F.min("importance") >= 0).alias("ordered"))


# streams ---------------------------------------------------------------------------


@query(
    "stream_hourly_mean",
    f"""SELECT {GRAIN}, {rounded_all(['RTM_LMP_HourlyAvg'])} FROM rtm
        WHERE TimestampHour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def stream_hourly_mean(t: Tables) -> DataFrame:
    """Runs the stream over all available input; hours not yet closed by the watermark are not in the result."""
    feed = I.read_feed(t.spark, t.sf_dir, t.spark.read.parquet(f"{t.sf_dir}/events.parquet").schema, pattern="events.parquet")
    renamed = feed.withColumnRenamed("event_type", KEY)
    path, checkpoint = scratch_path(t.spark, "stream-out"), scratch_path(t.spark, "stream-state")
    I.run_to_table(I.hourly_mean_stream(renamed, "ts", "value", S.RTM), path, checkpoint).awaitTermination()
    return t.spark.read.parquet(path)
