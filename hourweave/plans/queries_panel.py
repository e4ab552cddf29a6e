"""Queries over splits, samples, windows and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourweave.functions import scalar as S
from hourweave.functions.timeutil import HOUR, KEY
from hourweave.operators import aggregates as A
from hourweave.operators import quality as Q
from hourweave.operators import ranking as K
from hourweave.operators import windows as W
from hourweave.operators.quantiles import exact_quantiles
from hourweave.plans.bindings import Tables
from hourweave.plans.dataset import train_and_val
from hourweave.plans.features import realtime_prices
from hourweave.plans.oracle import PRICE_COLUMNS, rounded, rounded_all
from hourweave.plans.registry import query
from hourweave.session import materialise

GRAIN = "TimestampHour, SettlementPoint"
LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey")


# splits and samples ----------------------------------------------------------------


@query("chrono_split", f"SELECT {GRAIN}, {rounded_all(['DART'])}, split FROM splits")
def chrono_split(t: Tables) -> DataFrame:
    return t.split.select(HOUR, KEY, S.SPREAD, "split")


@query(
    "split_ranges",
    "SELECT split, count(*) AS n_rows, min(TimestampHour) AS first_hour, max(TimestampHour) AS last_hour FROM splits GROUP BY 1",
)
def split_ranges(t: Tables) -> DataFrame:
    return K.split_ranges(t.split)


@query(
    "chrono_split_2way",
    """SELECT event_id, CASE WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM (
         SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS pos, count(*) OVER () AS n FROM events) AS a""",
)
def chrono_split_2way(t: Tables) -> DataFrame:
    events = t["events"].select("event_id", "ts")
    return K.chronological_split(events, (0.8,), ("train", "test"), "ts", ("event_id",)).select("event_id", "split")


@query(
    "chrono_split_copies",
    """SELECT l_shipdate, l_returnflag, split, count(*) AS n_rows FROM (
         SELECT l_shipdate, l_returnflag, CASE WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train'
           WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) + floor(n * CAST(0.1 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM (
             SELECT l_shipdate, l_returnflag, row_number() OVER (ORDER BY l_shipdate, l_returnflag) AS pos, count(*) OVER () AS n
             FROM lineitem) AS a) AS b GROUP BY 1, 2, 3""",
)
def chrono_split_copies(t: Tables) -> DataFrame:
    rows = t["lineitem"].select("l_shipdate", "l_returnflag")
    parts = K.chronological_split_copies(rows, ts="l_shipdate", tie_break=("l_returnflag",))
    return parts.groupBy("l_shipdate", "l_returnflag", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "hash_sample",
    """SELECT event_id, ts, round(value, 6) AS value FROM (
         SELECT *, row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR))) AS pos FROM events) AS a WHERE pos <= 1000""",
)
def hash_sample(t: Tables) -> DataFrame:
    return K.hash_sample(t["events"], 1000, ["event_id"]).select("event_id", "ts", "value")


@query("union_train_val", "SELECT split, count(*) AS n_rows, round(sum(DART), 6) AS total FROM splits WHERE split IN ('train', 'val') GROUP BY 1")
def union_train_val(t: Tables) -> DataFrame:
    return train_and_val(t.split).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(S.SPREAD).alias("total"))


# windows ---------------------------------------------------------------------------


@query(
    "lag_features",
    f"SELECT {GRAIN}, {rounded('DART', 'DART')}, {', '.join(rounded(f'lag_{n}', f'DART_lag_{n}') for n in (1, 24, 168))} FROM lagged",
)
def lag_features(t: Tables) -> DataFrame:
    return W.lag_features(t.stored_spread.select(HOUR, KEY, S.SPREAD), S.SPREAD)


@query(
    "lag_features_calendar",
    f"""SELECT s.TimestampHour, s.SettlementPoint, {rounded('s.DART', 'DART')}, {rounded('a.DART', 'DART_lag_1h')},
          {rounded('b.DART', 'DART_lag_24h')}, {rounded('c.DART', 'DART_lag_168h')} FROM spread AS s
        LEFT JOIN spread AS a ON a.SettlementPoint = s.SettlementPoint AND a.TimestampHour = s.TimestampHour - INTERVAL 1 HOUR
        LEFT JOIN spread AS b ON b.SettlementPoint = s.SettlementPoint AND b.TimestampHour = s.TimestampHour - INTERVAL 24 HOUR
        LEFT JOIN spread AS c ON c.SettlementPoint = s.SettlementPoint AND c.TimestampHour = s.TimestampHour - INTERVAL 168 HOUR""",
)
def lag_features_calendar(t: Tables) -> DataFrame:
    return W.lag_features_calendar(t.spread.select(HOUR, KEY, S.SPREAD), S.SPREAD)


@query(
    "rolling_stats",
    f"""SELECT {GRAIN}, {rounded('y', 'y')},
          {rounded('CASE WHEN count(y) OVER a = 168 THEN avg(y) OVER a END', 'y_ma_168')},
          {rounded('CASE WHEN count(y) OVER b = 720 THEN avg(y) OVER b END', 'y_ma_720')},
          {rounded('CASE WHEN count(y) OVER a = 168 THEN stddev_samp(y) OVER a END', 'y_std_168')}
        FROM daily_panel WINDOW a AS (PARTITION BY SettlementPoint ORDER BY TimestampHour ROWS BETWEEN 167 PRECEDING AND CURRENT ROW),
          b AS (PARTITION BY SettlementPoint ORDER BY TimestampHour ROWS BETWEEN 719 PRECEDING AND CURRENT ROW)""",
)
def rolling_stats(t: Tables) -> DataFrame:
    return W.rolling_stats(t.daily_panel, "y")


@query(
    "sequence_windows",
    f"""SELECT {GRAIN}, CAST(24 AS BIGINT) AS n_history, {rounded('total - v', 'history_sum')}, {rounded('v', 'target')} FROM (
          SELECT TimestampHour, SettlementPoint, RTM_LMP_HourlyAvg AS v, lag(TimestampHour, 24) OVER w AS first_hour,
            sum(RTM_LMP_HourlyAvg) OVER (PARTITION BY SettlementPoint ORDER BY TimestampHour ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) AS total
          FROM rtm WINDOW w AS (PARTITION BY SettlementPoint ORDER BY TimestampHour)) AS a
        WHERE first_hour + INTERVAL 24 HOUR = TimestampHour""",
)
def sequence_windows(t: Tables) -> DataFrame:
    runs = W.sequence_windows(realtime_prices(t.market.read(t.spark, "rtm")), S.RTM)
    total = F.aggregate("history", F.lit(0.0), lambda a, x: a + x)
    return runs.select(HOUR, KEY, F.size("history").alias("n_history"), total.alias("history_sum"), F.col("target")[0].alias("target"))


@query(
    "sequence_columns",
    f"""SELECT {GRAIN}, {', '.join(rounded(f"{c}_sum", f"{c}_history") for c in ('DAM_Price_Hourly', 'RTM_LMP_HourlyAvg'))},
          {rounded('known', 'DAM_Price_Hourly_future')}, {rounded('DART', 'last_target')} FROM (
          SELECT *, lag(TimestampHour, 29) OVER w AS first_hour, sum(DAM_Price_Hourly) OVER early AS DAM_Price_Hourly_sum,
            sum(RTM_LMP_HourlyAvg) OVER early AS RTM_LMP_HourlyAvg_sum, sum(DAM_Price_Hourly) OVER late AS known
          FROM spread WINDOW w AS (PARTITION BY SettlementPoint ORDER BY TimestampHour), early AS (w ROWS BETWEEN 29 PRECEDING AND 6 PRECEDING),
            late AS (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)) AS a
        WHERE first_hour + INTERVAL 29 HOUR = TimestampHour""",
)
def sequence_columns(t: Tables) -> DataFrame:
    """24 hours of two prices, 6 hours ahead of the known day-ahead price and the spread to predict."""
    chunks = materialise(W.sequence_chunks(t.stored_spread, [S.DAM, S.RTM, S.SPREAD], 30), "sequence-chunks")
    windows = W.sequences(chunks, 24, 6, past=[S.DAM, S.RTM], future=[S.DAM], target=[S.SPREAD])
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x).alias(c)
    return windows.select(
        HOUR, KEY, total(f"{S.DAM}_history"), total(f"{S.RTM}_history"), total(f"{S.DAM}_future"), F.element_at(f"{S.SPREAD}_future", -1).alias("last_target"))


@query(
    "time_gaps",
    f"""SELECT {GRAIN}, lag(TimestampHour) OVER w AS previous_ts,
          CAST(date_diff('second', lag(TimestampHour) OVER w, TimestampHour) AS BIGINT) AS gap_seconds
        FROM spread WINDOW w AS (PARTITION BY SettlementPoint ORDER BY TimestampHour)""",
)
def time_gaps(t: Tables) -> DataFrame:
    return W.time_gaps(t.stored_spread)


@query(
    "time_gap_summary",
    """SELECT count(*) FILTER (WHERE date_diff('second', previous_ts, TimestampHour) = 3600) AS one_hour_steps,
         count(*) FILTER (WHERE date_diff('second', previous_ts, TimestampHour) > 3600) AS longer_gaps,
         CAST(max(date_diff('second', previous_ts, TimestampHour)) AS BIGINT) AS longest_gap_seconds FROM hour_steps""",
)
def time_gap_summary(t: Tables) -> DataFrame:
    return W.time_gap_summary(W.time_gaps(W.global_hours(t.stored_spread), key=[]))


@query(
    "first_time_gaps",
    f"""SELECT {GRAIN}, previous_ts, CAST(date_diff('second', previous_ts, TimestampHour) AS BIGINT) AS gap_seconds FROM (
          SELECT TimestampHour, SettlementPoint, lag(TimestampHour) OVER (PARTITION BY SettlementPoint ORDER BY TimestampHour) AS previous_ts
          FROM spread) AS a
        WHERE date_diff('second', previous_ts, TimestampHour) > 3600 ORDER BY TimestampHour, SettlementPoint LIMIT 10""",
)
def first_time_gaps(t: Tables) -> DataFrame:
    return W.first_gaps(W.time_gaps(t.stored_spread))


# quality ---------------------------------------------------------------------------


@query(
    "duplicate_keys",
    """SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys,
         count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem""",
)
def duplicate_keys(t: Tables) -> DataFrame:
    return Q.duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"])


@query("missing_pct", "SELECT " + ", ".join(f"round(100.0 * avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 2) AS {c}" for c in PRICE_COLUMNS) + " FROM panel")
def missing_pct(t: Tables) -> DataFrame:
    return Q.missing_pct(t.panel, PRICE_COLUMNS)


@query(
    "null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS non_null, count(*) - count({c}) AS nulls, "
        f"round((count(*) - count({c})) * CAST(100 AS DOUBLE) / count(*), 6) AS null_pct, "
        f"(count(*) - count({c})) * 2 > count(*) AS mostly_null FROM panel"
        for c in ("TimestampHour", "SettlementPoint", *PRICE_COLUMNS)
    ),
)
def null_profile(t: Tables) -> DataFrame:
    return Q.null_profile(t.panel, [HOUR, KEY, *PRICE_COLUMNS])


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", {rounded(f'avg({c})', 'mean')}, {rounded(f'stddev_samp({c})', 'std')}, "
        f"round(CAST(min({c}) AS DOUBLE), 6) AS \"min\", round(CAST(max({c}) AS DOUBLE), 6) AS \"max\", "
        + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), 0.{q}), 6) AS q{q}" for q in (25, 50, 75))
        + " FROM lineitem"
        for c in LINE_NUMBERS
    ),
)
def describe_numeric(t: Tables) -> DataFrame:
    return Q.describe_numeric(t["lineitem"], LINE_NUMBERS)


@query(
    "prediction_summary",
    f"""SELECT SettlementPoint, count(DART) AS n_rows, {rounded('avg(DART)', 'mean')}, {rounded('stddev_samp(DART)', 'std')},
          {rounded('min(DART)', '"min"')}, {rounded('max(DART)', '"max"')} FROM spread GROUP BY 1""",
)
def prediction_summary(t: Tables) -> DataFrame:
    return A.prediction_summary(t.spread, S.SPREAD, by=[KEY])


@query(
    "spread_quantiles",
    " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS prob, round(quantile_cont(DART, {p}), 6) AS value FROM spread" for p in (0.25, 0.5, 0.75)
    ),
)
def spread_quantiles(t: Tables) -> DataFrame:
    return exact_quantiles(t.stored_spread, [S.SPREAD], [0.25, 0.5, 0.75]).select("prob", "value")


@query(
    "regime_distribution",
    """SELECT CAST(regime AS BIGINT) AS regime, count(*) AS n_rows, round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM spread), 6) AS pct
       FROM (SELECT CASE WHEN abs(DART) >= 100 THEN 3 WHEN abs(DART) >= 50 THEN 2 WHEN abs(DART) >= 10 THEN 1 ELSE 0 END AS regime
             FROM spread) AS a GROUP BY 1""",
)
def regime_distribution(t: Tables) -> DataFrame:
    return A.regime_distribution(t.stored_spread.select(S.regime(F.col(S.SPREAD)).alias("regime")))


AVAILABILITY = """SELECT count(*) AS n_rows, count(DAM_Price_Hourly) AS dam_rows, count(RTM_LMP_HourlyAvg) AS rtm_rows,
                    count(DAM_Price_Hourly - RTM_LMP_HourlyAvg) AS spread_rows FROM panel"""


@query(
    "price_availability",
    f"""SELECT *, {', '.join(f'round({c}_rows * CAST(100 AS DOUBLE) / n_rows, 6) AS {c}_pct' for c in ('dam', 'rtm', 'spread'))},
          CASE WHEN spread_rows = 0 THEN 'fail' WHEN spread_rows < n_rows * 0.5 THEN 'warn' ELSE 'pass' END AS status
        FROM ({AVAILABILITY}) AS a""",
)
def price_availability(t: Tables) -> DataFrame:
    return Q.price_availability(t.panel)


@query(
    "validation_report",
    """SELECT 'rows' AS "check", CAST(count(*) AS DOUBLE) AS value, CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END AS status FROM panel
       UNION ALL SELECT 'required_columns', 0, 'pass'
       UNION ALL SELECT 'null_columns', """
    + " + ".join(f"max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in ("TimestampHour", "SettlementPoint", *PRICE_COLUMNS))
    + """, 'info' FROM panel
       UNION ALL SELECT 'mostly_null_columns', m, CASE WHEN m = 0 THEN 'pass' ELSE 'warn' END FROM (SELECT """
    + " + ".join(f"CASE WHEN count({c}) * 2 < count(*) THEN 1 ELSE 0 END" for c in PRICE_COLUMNS)
    + f""" AS m FROM panel) AS a
       UNION ALL SELECT 'spread_rows', spread_rows, CASE WHEN spread_rows = 0 THEN 'fail' WHEN spread_rows * 2 < n_rows THEN 'warn' ELSE 'pass' END
         FROM ({AVAILABILITY}) AS b
       UNION ALL SELECT 'numeric_columns', 3, 'info'
       UNION ALL SELECT 'entities', count(DISTINCT SettlementPoint), 'info' FROM panel
       UNION ALL SELECT 'time_gaps', g, CASE WHEN g <= 100 THEN 'pass' ELSE 'warn' END FROM (
         SELECT count(*) FILTER (WHERE date_diff('second', p, h) > 3600) AS g FROM (
           SELECT h, lag(h) OVER (ORDER BY h) AS p FROM (SELECT DISTINCT TimestampHour AS h FROM panel) AS c) AS d) AS e
       UNION ALL SELECT 'duplicates', count(*) - count(DISTINCT (TimestampHour, SettlementPoint)),
         CASE WHEN count(*) = count(DISTINCT (TimestampHour, SettlementPoint)) THEN 'pass' ELSE 'fail' END FROM panel""",
)
def validation_report(t: Tables) -> DataFrame:
    return Q.validation_report(t.panel_table)


PSI_BINS = ", ".join(f"quantile_cont(DART, {i / 10})" for i in range(1, 10))


@query(
    "drift_psi",
    f"""SELECT count(*) AS bins, round(sum((a - e) * ln(a / e)), 6) AS psi FROM (
          SELECT coalesce(te.bin, tr.bin) AS bin, greatest(coalesce(te.c, 0) / (SELECT CAST(count(*) AS DOUBLE) FROM splits WHERE split = 'test'), 1e-6) AS a,
            greatest(coalesce(tr.c, 0) / (SELECT CAST(count(*) AS DOUBLE) FROM train), 1e-6) AS e
          FROM (SELECT bin, count(*) AS c FROM (SELECT len(list_filter(edges, lambda x: x < DART)) AS bin FROM splits,
                  (SELECT [{PSI_BINS}] AS edges FROM train) AS q WHERE split = 'test') AS t1 GROUP BY 1) AS te
          FULL OUTER JOIN (SELECT bin, count(*) AS c FROM (SELECT len(list_filter(edges, lambda x: x < DART)) AS bin FROM train,
                  (SELECT [{PSI_BINS}] AS edges FROM train) AS q) AS t2 GROUP BY 1) AS tr ON te.bin = tr.bin) AS z""",
)
def drift_psi(t: Tables) -> DataFrame:
    parts = {s: t.split.filter(F.col("split") == s) for s in ("train", "test")}
    return Q.drift_psi(parts["train"], parts["test"], S.SPREAD)
