"""Named views in ANSI SQL over the driver's tables, put in front of expected-result queries."""

from __future__ import annotations

import re

from hourweave.plans.bindings import FORECAST_ZONE_OF, WEATHER_ZONE_OF, WIND_REGION_OF

HOUR_OF_LABEL = "CAST({day} AS TIMESTAMP) + to_hours(CAST(split_part({label}, ':', 1) AS INTEGER) - 1)"


def rounded(expr: str, name: str) -> str:
    """Six decimals; adding 0 turns -0.0 into 0.0."""
    return f"round({expr}, 6) + CAST(0 AS DOUBLE) AS {name}"


def rounded_all(columns) -> str:
    return ", ".join(rounded(c, c) for c in columns)


def _sums(zones: dict[str, str], value: str, prefix: str) -> str:
    return ", ".join(f"sum(CASE WHEN event_type = '{kind}' THEN {value} END) AS {prefix}{zone}" for zone, kind in zones.items())


FZ_COLUMNS = [f"LoadFZ_{z}_Hourly" for z in (*FORECAST_ZONE_OF, "TOTAL")]
WZ_COLUMNS = [f"LoadWZ_{z}_Hourly" for z in WEATHER_ZONE_OF]
SOLAR_5MIN_COLUMNS = ["Solar_Actual_5min_Hourly", "Solar_HSL_5min_Hourly"]
SOLAR_COLUMNS = [
    "Solar_Actual_Hourly", "Solar_COP_HSL_Hourly", "Solar_Forecast_STPPF_Hourly", "Solar_Forecast_PVGRPP_Hourly", "Solar_HSL_Hourly",
]
WIND_COLUMNS = ["Wind_Actual_System_Hourly", "Wind_HSL_System_Hourly"] + [f"Wind_Actual_{r}_Hourly" for r in WIND_REGION_OF]
PRICE_COLUMNS = ["DAM_Price_Hourly", "RTM_LMP_HourlyAvg", "RTM_LMP_HourlyAvg_Alt"]
GLOBAL_COLUMNS = FZ_COLUMNS + WZ_COLUMNS + SOLAR_5MIN_COLUMNS + SOLAR_COLUMNS + WIND_COLUMNS
CONTINUOUS = ["RTM_LMP_HourlyAvg_Alt", *GLOBAL_COLUMNS]

VIEWS: dict[str, str] = {
    "ev": "SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, date_trunc('hour', ts) AS h FROM events",
    "dam": """SELECT h + INTERVAL 1 DAY AS TimestampHour, event_type AS SettlementPoint, avg(value) AS DAM_Price_Hourly
              FROM ev GROUP BY 1, 2""",
    "rtm": "SELECT h AS TimestampHour, event_type AS SettlementPoint, avg(value) AS RTM_LMP_HourlyAvg FROM ev GROUP BY 1, 2",
    "rtm_alt": "SELECT h AS TimestampHour, event_type AS SettlementPoint, avg(k) AS RTM_LMP_HourlyAvg_Alt FROM ev GROUP BY 1, 2",
    "load_fz": f"SELECT h AS TimestampHour, {_sums(FORECAST_ZONE_OF, 'value', '')}, sum(value) AS TOTAL FROM ev GROUP BY 1",
    "hourly_fz": "SELECT TimestampHour, "
    + ", ".join(f"{z} AS LoadFZ_{z}_Hourly" for z in (*FORECAST_ZONE_OF, "TOTAL"))
    + " FROM load_fz",
    "hourly_wz": "SELECT TimestampHour, "
    + ", ".join(f"{z} AS LoadWZ_{z}_Hourly" for z in WEATHER_ZONE_OF)
    + f" FROM (SELECT h AS TimestampHour, {_sums(WEATHER_ZONE_OF, 'k', '')} FROM ev GROUP BY 1) AS w"
    + f" WHERE coalesce({', '.join(WEATHER_ZONE_OF)}) IS NOT NULL",
    "hourly_s5": """SELECT h AS TimestampHour, avg(value) AS Solar_Actual_5min_Hourly, avg(k) AS Solar_HSL_5min_Hourly
                    FROM ev GROUP BY 1""",
    "hourly_solar": """SELECT h AS TimestampHour, sum(value) AS Solar_Actual_Hourly, sum(k) AS Solar_COP_HSL_Hourly,
                       avg(value) AS Solar_Forecast_STPPF_Hourly, avg(k) AS Solar_Forecast_PVGRPP_Hourly,
                       max(value) AS Solar_HSL_Hourly FROM ev GROUP BY 1""",
    "hourly_wind": "SELECT h AS TimestampHour, sum(value) AS Wind_Actual_System_Hourly, sum(value + k) AS Wind_HSL_System_Hourly, "
    + ", ".join(f"sum(CASE WHEN event_type = '{kind}' THEN value END) AS Wind_Actual_{r}_Hourly" for r, kind in WIND_REGION_OF.items())
    + " FROM ev GROUP BY 1",
    "panel_two": "SELECT * FROM dam FULL OUTER JOIN rtm USING (TimestampHour, SettlementPoint)",
    "panel": "SELECT * FROM panel_two FULL OUTER JOIN rtm_alt USING (TimestampHour, SettlementPoint)",
    "unified": """SELECT * FROM panel
                  LEFT JOIN hourly_fz USING (TimestampHour) LEFT JOIN hourly_wz USING (TimestampHour)
                  LEFT JOIN hourly_s5 USING (TimestampHour) LEFT JOIN hourly_solar USING (TimestampHour)
                  LEFT JOIN hourly_wind USING (TimestampHour)""",
    "spread": """SELECT *, DAM_Price_Hourly - RTM_LMP_HourlyAvg AS DART FROM panel
                 WHERE DAM_Price_Hourly IS NOT NULL AND RTM_LMP_HourlyAvg IS NOT NULL""",
    "ranked": """SELECT *, row_number() OVER (ORDER BY TimestampHour, SettlementPoint) AS pos, count(*) OVER () AS n FROM spread""",
    "splits": """SELECT * EXCLUDE (pos, n), CASE
                   WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train'
                   WHEN pos <= floor(n * CAST(0.8 AS DOUBLE)) + floor(n * CAST(0.1 AS DOUBLE)) THEN 'val'
                   ELSE 'test' END AS split FROM ranked""",
    "train": "SELECT * FROM splits WHERE split = 'train'",
    "unified_split": """SELECT s.DART, s.split, u.* FROM splits AS s JOIN unified AS u
                        ON s.TimestampHour = u.TimestampHour AND s.SettlementPoint = u.SettlementPoint""",
    "encoding": """SELECT SettlementPoint AS category, count(*) AS n,
                     avg(DART) / (1 + exp(20.0 - count(*)))
                     + (1 - 1 / (1 + exp(20.0 - count(*)))) * (SELECT avg(DART) FROM train) AS encoding
                   FROM train GROUP BY 1""",
    "scaling": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(coalesce({c}, 0)) AS mean, "
        f"CASE WHEN max(coalesce({c}, 0)) > min(coalesce({c}, 0)) THEN stddev_pop(coalesce({c}, 0)) ELSE 1 END AS std "
        "FROM unified_split WHERE split = 'train'"
        for c in CONTINUOUS
    ),
    "lagged": """SELECT *, lag(DART, 1) OVER w AS lag_1, lag(DART, 24) OVER w AS lag_24, lag(DART, 168) OVER w AS lag_168
                 FROM splits WINDOW w AS (PARTITION BY SettlementPoint ORDER BY TimestampHour)""",
    "key_means": "SELECT SettlementPoint, avg(DART) AS key_mean FROM train GROUP BY 1",
    "naive": """SELECT TimestampHour, SettlementPoint, split, model, y, prediction FROM (
                  SELECT TimestampHour, SettlementPoint, split, 'previous' AS model, DART AS y, lag_1 AS prediction FROM lagged
                  UNION ALL SELECT TimestampHour, SettlementPoint, split, 'day_back', DART, lag_24 FROM lagged
                  UNION ALL SELECT l.TimestampHour, l.SettlementPoint, l.split, 'key_mean', l.DART, m.key_mean
                    FROM lagged AS l LEFT JOIN key_means AS m ON l.SettlementPoint = m.SettlementPoint
                ) AS a WHERE prediction IS NOT NULL""",
    "scores": """SELECT model, split, count(*) AS n_rows, sqrt(avg(power(y - prediction, 2))) AS rmse, avg(abs(y - prediction)) AS mae,
                   avg(abs((y - prediction) / (abs(y) + 1e-10))) * 100 AS mape,
                   1 - sum(power(y - prediction, 2)) / sum(power(y - m, 2)) AS r2
                 FROM (SELECT *, avg(y) OVER (PARTITION BY model, split) AS m FROM naive) AS a GROUP BY 1, 2""",
    "board": """SELECT model, max(CASE WHEN split = 'val' THEN rmse END) AS val_rmse, max(CASE WHEN split = 'val' THEN mae END) AS val_mae,
                  max(CASE WHEN split = 'test' THEN rmse END) AS test_rmse, max(CASE WHEN split = 'test' THEN mae END) AS test_mae
                FROM scores GROUP BY 1""",
    "jobs": "SELECT model FROM board UNION ALL SELECT 'pending_model' AS model",
    "joined_board": "SELECT * FROM jobs LEFT JOIN board USING (model)",
    "weights": "SELECT model, rmse AS val_rmse, (1 / rmse) / (SELECT sum(1 / rmse) FROM scores WHERE split = 'val') AS weight FROM scores WHERE split = 'val'",
    "blend": """SELECT TimestampHour, SettlementPoint, split, max(y) AS y, sum(weight * prediction) / sum(weight) AS prediction
                FROM naive JOIN weights USING (model) GROUP BY 1, 2, 3""",
    "regimes": """SELECT *, CASE WHEN abs(y) >= 100 THEN 3 WHEN abs(y) >= 50 THEN 2 WHEN abs(y) >= 10 THEN 1 ELSE 0 END AS actual,
                    CASE WHEN abs(prediction) >= 100 THEN 3 WHEN abs(prediction) >= 50 THEN 2 WHEN abs(prediction) >= 10 THEN 1 ELSE 0 END AS predicted
                  FROM naive""",
    "class_sums": """SELECT model, label, sum(tp) AS tp, sum(support) AS support, sum(claimed) AS claimed FROM (
                       SELECT model, actual AS label, CASE WHEN actual = predicted THEN 1 ELSE 0 END AS tp, 1 AS support, 0 AS claimed FROM regimes
                       UNION ALL SELECT model, predicted, 0, 0, 1 FROM regimes) AS a GROUP BY 1, 2""",
    "class_rows": """SELECT model, label, CASE WHEN claimed > 0 THEN tp / claimed ELSE 0.0 END AS "precision",
                       CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, 2.0 * tp / (support + claimed) AS f1, support, tp
                     FROM (SELECT model, label, CAST(tp AS DOUBLE) AS tp, CAST(support AS DOUBLE) AS support, CAST(claimed AS DOUBLE) AS claimed
                           FROM class_sums) AS a""",
    "key_quantiles": """SELECT SettlementPoint, quantile_cont(DART, 0.1) AS p10, quantile_cont(DART, 0.5) AS p50, quantile_cont(DART, 0.9) AS p90
                        FROM train GROUP BY 1""",
    "intervals": """SELECT s.TimestampHour, s.SettlementPoint, s.split, s.DART AS y, p10, p50, p90
                    FROM splits AS s LEFT JOIN key_quantiles AS q ON s.SettlementPoint = q.SettlementPoint""",
    "test_intervals": "SELECT * FROM intervals WHERE split = 'test'",
    "daily_panel": "SELECT o_orderdate AS TimestampHour, o_orderpriority AS SettlementPoint, ln(avg(o_totalprice)) AS y FROM orders GROUP BY 1, 2",
    "hour_steps": """SELECT h AS TimestampHour, lag(h) OVER (ORDER BY h) AS previous_ts FROM (SELECT DISTINCT TimestampHour AS h FROM spread) AS a""",
    "stages": """SELECT s.*, coalesce(g.da, (SELECT avg(DAM_Price_Hourly) FROM train)) AS da_pred,
                   coalesce(g.rt, (SELECT avg(RTM_LMP_HourlyAvg) FROM train)) AS rt_pred
                 FROM splits AS s LEFT JOIN (
                   SELECT SettlementPoint, hour(TimestampHour) AS hr, avg(DAM_Price_Hourly) AS da, avg(RTM_LMP_HourlyAvg) AS rt
                   FROM train GROUP BY 1, 2) AS g
                 ON s.SettlementPoint = g.SettlementPoint AND hour(s.TimestampHour) = g.hr""",
    "constraint_rows": """SELECT h AS TimestampHour, max(value) AS price_max, avg(value) AS price_avg, max(value - k) AS violation,
                            count(DISTINCT user_id) AS binding FROM ev GROUP BY 1""",
}

_NAMES = re.compile(r"\b(" + "|".join(sorted(VIEWS, key=len, reverse=True)) + r")\b")


def with_views(sql: str) -> str:
    """Prefix `sql` with the views it uses, directly or through others."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        found = set(_NAMES.findall(todo.pop())) - needed
        needed |= found
        todo.extend(VIEWS[name] for name in found)
    ctes = [f"{name} AS ({body})" for name, body in VIEWS.items() if name in needed]
    return f"WITH {', '.join(ctes)} {sql}" if ctes else sql
