"""Queries over sources, scalar functions, reshaping, joins and hourly roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourweave.functions import scalar as S
from hourweave.functions import timeutil as TU
from hourweave.functions.timeutil import HOUR, KEY
from hourweave.operators import aggregates as A
from hourweave.operators import joins as J
from hourweave.operators import reshape as R
from hourweave.plans import features as P
from hourweave.plans.bindings import FORECAST_ZONE_OF, Tables
from hourweave.plans.oracle import (
    FZ_COLUMNS, GLOBAL_COLUMNS, PRICE_COLUMNS, SOLAR_5MIN_COLUMNS, SOLAR_COLUMNS, WIND_COLUMNS, rounded, rounded_all,
)
from hourweave.plans.registry import query
from hourweave.sources.readers import request_rows
from hourweave.sources.sinks import PARTITIONS, prediction_rows, with_partitions

GRAIN = "TimestampHour, SettlementPoint"


# sources ---------------------------------------------------------------------------


@query("scan_events", "SELECT event_id, ts, user_id, event_type, round(value, 6) AS value FROM events")
def scan_events(t: Tables) -> DataFrame:
    return t["events"].select("event_id", "ts", "user_id", "event_type", "value")


@query(
    "scan_parquet_pruned",
    """SELECT l_suppkey, l_shipdate, round(l_quantity, 6) AS l_quantity FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'""",
)
def scan_parquet_pruned(t: Tables) -> DataFrame:
    year = [F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1997-01-01")]
    rows = t["lineitem"].filter((F.col("l_shipdate") >= year[0]) & (F.col("l_shipdate") < year[1]))
    return rows.select("l_suppkey", "l_shipdate", "l_quantity")


@query("json_props_extract", "SELECT event_id, round(k, 6) AS k FROM ev")
def json_props_extract(t: Tables) -> DataFrame:
    requests = t["events"].select("event_id", F.concat(F.lit('{"data": ['), "props", F.lit("]}")).alias("value"))
    return request_rows(requests, ["k"], keep=["event_id"]).select("event_id", "k")


@query(
    "publish_partitions",
    """SELECT CAST(year(h) AS BIGINT) AS year, CAST(month(h) AS BIGINT) AS month, CAST(day(h) AS BIGINT) AS day,
         CAST(hour(h) AS BIGINT) AS hour, count(*) AS n_rows, min(kind) AS first_kind
       FROM (SELECT TimestampHour AS h, 'naive' AS kind FROM rtm) AS a GROUP BY 1, 2, 3, 4""",
)
def publish_partitions(t: Tables) -> DataFrame:
    rows = prediction_rows(P.realtime_prices(t.market.read(t.spark, "rtm")), S.RTM, "naive")
    return with_partitions(rows).groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n_rows"), F.min("ModelType").alias("first_kind"))


# scalar functions ------------------------------------------------------------------


@query(
    "rename_select",
    """SELECT l_shipdate AS SCEDTimeStamp, l_suppkey AS ConstraintName, round(l_extendedprice, 6) AS ShadowPrice FROM lineitem""",
)
def rename_select(t: Tables) -> DataFrame:
    names = {"l_shipdate": "SCEDTimeStamp", "l_suppkey": "ConstraintName", "l_extendedprice": "ShadowPrice", "l_absent": "ViolatedMW"}
    return S.rename_select(t["lineitem"], names)


@query("hour_ending_parse", "SELECT event_id, CAST(hour(ts) + 1 AS BIGINT) AS hour_ending FROM events")
def hour_ending_parse(t: Tables) -> DataFrame:
    number = F.hour("ts") + 1
    label = (
        F.when(F.minute("ts") < 20, F.concat(F.lpad(number.cast("string"), 2, "0"), F.lit(":00")))
        .when(F.minute("ts") < 40, number.cast("string"))
        .otherwise(number.cast("double").cast("string"))
    )
    return t["events"].select("event_id", TU.hour_ending(label).alias("hour_ending"))


@query("operday_to_hour", "SELECT TimestampHour, round(TOTAL, 6) AS TOTAL FROM load_fz")
def operday_to_hour(t: Tables) -> DataFrame:
    return TU.operday_to_hour(t.market.read(t.spark, "load_forecast_zone")).select(HOUR, "TOTAL")


@query("deliverydate_to_hour", "SELECT event_id, h AS TimestampHour FROM ev")
def deliverydate_to_hour(t: Tables) -> DataFrame:
    labelled = t["events"].select("event_id", F.col("ts").alias("DeliveryDate"), (F.hour("ts") + 1).alias("HourEnding"))
    return TU.deliverydate_to_hour(labelled).select("event_id", HOUR)


@query("floor_hour", "SELECT event_id, h AS TimestampHour FROM ev")
def floor_hour(t: Tables) -> DataFrame:
    return TU.interval_to_hour(t["events"], "ts").select("event_id", HOUR)


@query("dart_target", f"SELECT {GRAIN}, {rounded_all(['DAM_Price_Hourly', 'RTM_LMP_HourlyAvg', 'DART'])} FROM spread")
def dart_target(t: Tables) -> DataFrame:
    return t.spread.select(HOUR, KEY, S.DAM, S.RTM, S.SPREAD)


@query(
    "regime_labels",
    f"""SELECT {GRAIN}, CAST(CASE WHEN abs(DART) >= 100 THEN 3 WHEN abs(DART) >= 50 THEN 2 WHEN abs(DART) >= 10 THEN 1 ELSE 0 END AS BIGINT)
        AS regime FROM spread""",
)
def regime_labels(t: Tables) -> DataFrame:
    return t.spread.select(HOUR, KEY, S.regime(F.col(S.SPREAD)).alias("regime"))


@query(
    "calendar_features",
    """SELECT event_id, CAST(hour(ts) AS BIGINT) AS Hour, CAST(isodow(ts) - 1 AS BIGINT) AS DayOfWeek, CAST(month(ts) AS BIGINT) AS Month,
         CAST(quarter(ts) AS BIGINT) AS Quarter, CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS IsWeekend FROM events""",
)
def calendar_features(t: Tables) -> DataFrame:
    return TU.calendar_features(t["events"].select("event_id", "ts"), "ts").drop("ts")


@query(
    "cyclic_features",
    f"""SELECT event_id, {rounded('sin(2 * pi() * hour(ts) / 24)', 'hour_sin')}, {rounded('cos(2 * pi() * hour(ts) / 24)', 'hour_cos')},
          {rounded('sin(2 * pi() * month(ts) / 12)', 'month_sin')}, {rounded('cos(2 * pi() * month(ts) / 12)', 'month_cos')} FROM events""",
)
def cyclic_features(t: Tables) -> DataFrame:
    return TU.cyclic_features(t["events"].select("event_id", "ts"), "ts").drop("ts")


INTERACTION_PRODUCTS = {
    "hour_weekend": ("Hour", "IsWeekend"),
    "hour_season": ("Hour", "Quarter"),
    "temp_load_interaction": ("Solar_HSL_5min_Hourly", "LoadFZ_TOTAL_Hourly"),  # second measure in place of a temperature
    "absent_interaction": ("Hour", "Temperature"),
}
INTERACTION_RATIOS = {
    "price_to_load_ratio": ("RTM_LMP_HourlyAvg", "LoadFZ_TOTAL_Hourly"),
    "wind_to_load_ratio": ("Wind_Actual_System_Hourly", "LoadFZ_TOTAL_Hourly"),
    "wind_capacity_factor": ("Wind_Actual_System_Hourly", "Wind_HSL_System_Hourly"),
    "solar_capacity_factor": ("Solar_Actual_Hourly", "Solar_HSL_Hourly"),
}


@query(
    "interaction_features",
    f"""SELECT {GRAIN}, CAST(hour(TimestampHour) * CASE WHEN isodow(TimestampHour) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS hour_weekend,
          CAST(hour(TimestampHour) * quarter(TimestampHour) AS BIGINT) AS hour_season,
          {rounded('Solar_HSL_5min_Hourly * LoadFZ_TOTAL_Hourly', 'temp_load_interaction')},
          {', '.join(rounded(f'{a} / ({b} + 1)', name) for name, (a, b) in INTERACTION_RATIOS.items())} FROM unified""",
)
def interaction_features(t: Tables) -> DataFrame:
    made = S.interactions(TU.calendar_features(t.unified), INTERACTION_PRODUCTS, INTERACTION_RATIOS)
    wanted = [c for c in (*INTERACTION_PRODUCTS, *INTERACTION_RATIOS) if c in made.columns]
    return made.select(HOUR, KEY, *wanted)


@query(
    "clip_values",
    f"""SELECT event_id, {rounded('greatest(0, least(value, 150))', 'clipped')}, {rounded('greatest(0, value - 50)', 'floored')} FROM events""",
)
def clip_values(t: Tables) -> DataFrame:
    return t["events"].select(
        "event_id", S.clip(F.col("value"), 0.0, 150.0).alias("clipped"), S.clip(F.col("value") - 50, low=0.0).alias("floored")
    )


@query(
    "time_index",
    f"""SELECT {GRAIN}, CAST(date_diff('hour', (SELECT min(TimestampHour) FROM train), TimestampHour) AS BIGINT) AS time_idx FROM splits""",
)
def time_index(t: Tables) -> DataFrame:
    data = t.split.select(HOUR, KEY, "split")
    return TU.time_index(data, data.filter(F.col("split") == "train")).select(HOUR, KEY, "time_idx")


@query(
    "align_features",
    f"""SELECT TimestampHour, {', '.join(rounded(f'coalesce({c}, 0)', c) for c in FZ_COLUMNS)}, CAST(0 AS DOUBLE) AS LoadWZ_EAST_Hourly,
          CAST(0 AS DOUBLE) AS Wind_HSL_System_Hourly FROM hourly_fz""",
)
def align_features(t: Tables) -> DataFrame:
    load = P.forecast_zone_load(t.market.read(t.spark, "load_forecast_zone"))
    return S.align_features(load, [*FZ_COLUMNS, "LoadWZ_EAST_Hourly", "Wind_HSL_System_Hourly"], keep=[HOUR])


@query(
    "filter_predicates",
    """SELECT o_orderkey, o_orderpriority, round(o_totalprice, 6) AS o_totalprice FROM orders
       WHERE o_orderdate IS NOT NULL AND o_totalprice > 100000 AND o_orderstatus = 'F' AND contains(o_orderpriority, 'URGENT')""",
)
def filter_predicates(t: Tables) -> DataFrame:
    rows = t.where(
        "orders", (F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").contains("URGENT")
    )
    return rows.dropna(subset=["o_orderdate"]).select("o_orderkey", "o_orderpriority", "o_totalprice")


# reshape ---------------------------------------------------------------------------


@query(
    "melt_load",
    "SELECT TimestampHour, 'Load_' || Zone || '_Hourly' AS Feature, round(LoadValue, 6) AS LoadValue FROM ("
    + " UNION ALL ".join(f"SELECT TimestampHour, '{z}' AS Zone, {z} AS LoadValue FROM load_fz" for z in (*FORECAST_ZONE_OF, "TOTAL"))
    + ") AS m",
)
def melt_load(t: Tables) -> DataFrame:
    load = TU.operday_to_hour(t.market.read(t.spark, "load_forecast_zone"))
    long = R.melt(load, [HOUR], R.FORECAST_ZONES)
    return long.select(HOUR, R.load_name(F.col("Zone")).alias("Feature"), "LoadValue")


@query(
    "pivot_load",
    "SELECT h AS TimestampHour, "
    + ", ".join(
        f"round(arg_min(CASE WHEN event_type = '{k}' THEN value END, CASE WHEN event_type = '{k}' THEN event_id END), 6) AS Load_{k}_Hourly"
        for k in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM ev GROUP BY 1",
)
def pivot_load(t: Tables) -> DataFrame:
    long = TU.interval_to_hour(t["events"], "ts").withColumn("Feature", R.load_name(F.col("event_type")))
    wanted = [f"Load_{k}_Hourly" for k in ("click", "error", "purchase", "signup", "view")]
    return R.pivot_first(long, [HOUR], "Feature", "value", wanted, F.col("event_id"))


@query("load_zones_wide", f"SELECT TimestampHour, {rounded_all(FZ_COLUMNS)} FROM hourly_fz")
def load_zones_wide(t: Tables) -> DataFrame:
    return P.forecast_zone_load(t.market.read(t.spark, "load_forecast_zone"))


@query("regional_wide", f"SELECT TimestampHour, {rounded_all(WIND_COLUMNS)} FROM hourly_wind")
def regional_wide(t: Tables) -> DataFrame:
    return P.wind_hourly(t.market.read(t.spark, "wind_hourly"))


@query("solar_hourly", f"SELECT TimestampHour, {rounded_all(SOLAR_COLUMNS)} FROM hourly_solar")
def solar_hourly(t: Tables) -> DataFrame:
    return P.solar_hourly(t.market.read(t.spark, "solar_hourly"))


@query("dam_prices", f"SELECT {GRAIN}, {rounded_all(['DAM_Price_Hourly'])} FROM dam")
def dam_prices(t: Tables) -> DataFrame:
    return P.dam_prices(t.market.read(t.spark, "dam"))


# joins -----------------------------------------------------------------------------


@query("outer_join_prices", f"SELECT {GRAIN}, {rounded_all(PRICE_COLUMNS[:2])} FROM panel_two")
def outer_join_prices(t: Tables) -> DataFrame:
    read = t.market.read
    return J.outer_join([P.dam_prices(read(t.spark, "dam")), P.realtime_prices(read(t.spark, "rtm"))])


@query("outer_join_three", f"SELECT {GRAIN}, {rounded_all(PRICE_COLUMNS)} FROM panel")
def outer_join_three(t: Tables) -> DataFrame:
    read = t.market.read
    realtime = [P.realtime_prices(read(t.spark, role), out) for role, out in (("rtm", S.RTM), ("rtm_alt", S.RTM_ALT))]
    return J.outer_join([P.dam_prices(read(t.spark, "dam")), *realtime])


@query("price_panel", f"SELECT {GRAIN}, {rounded_all(PRICE_COLUMNS)} FROM panel")
def price_panel(t: Tables) -> DataFrame:
    return t.panel


@query(
    "left_join_globals",
    f"""SELECT {GRAIN}, {rounded_all([*PRICE_COLUMNS, *FZ_COLUMNS, *SOLAR_5MIN_COLUMNS])} FROM panel
        LEFT JOIN hourly_fz USING (TimestampHour) LEFT JOIN hourly_s5 USING (TimestampHour)""",
)
def left_join_globals(t: Tables) -> DataFrame:
    read = t.market.read
    load, solar = P.forecast_zone_load(read(t.spark, "load_forecast_zone")), P.solar_5min(read(t.spark, "solar_5min"))
    return J.join_hourly(t.panel, [load, solar])


@query(
    "outer_fan_in",
    f"""SELECT TimestampHour, {rounded_all([*SOLAR_5MIN_COLUMNS, *SOLAR_COLUMNS, *WIND_COLUMNS])} FROM hourly_s5
        FULL OUTER JOIN hourly_solar USING (TimestampHour) FULL OUTER JOIN hourly_wind USING (TimestampHour)""",
)
def outer_fan_in(t: Tables) -> DataFrame:
    return P.hourly_solar_wind(t.spark, t.market)


@query(
    "constraint_system_join",
    f"""SELECT {GRAIN}, {rounded_all(PRICE_COLUMNS)}, {rounded('price_max', 'System_ShadowPrice_Max')},
          {rounded('price_avg', 'System_ShadowPrice_Avg')}, {rounded('violation', 'System_Violation_Max')},
          binding AS Binding_Constraints FROM panel LEFT JOIN constraint_rows USING (TimestampHour)""",
)
def constraint_system_join(t: Tables) -> DataFrame:
    per_constraint = P.constraints(t.market.read(t.spark, "constraints"))
    return J.join_hourly(t.panel, [A.constraint_system(per_constraint)])


@query("unified_features", f"SELECT {GRAIN}, {rounded_all([*PRICE_COLUMNS, *GLOBAL_COLUMNS])} FROM unified")
def unified(t: Tables) -> DataFrame:
    return t.unified


# aggregations ----------------------------------------------------------------------


@query("hourly_mean", f"SELECT {GRAIN}, {rounded_all(['RTM_LMP_HourlyAvg'])} FROM rtm")
def hourly_mean(t: Tables) -> DataFrame:
    return P.realtime_prices(t.market.read(t.spark, "rtm"))


@query(
    "constraint_hourly",
    f"""SELECT date_trunc('hour', l_shipdate) AS TimestampHour, CAST(l_suppkey AS VARCHAR) AS ConstraintName,
          {rounded('max(l_extendedprice)', 'ShadowPrice_HourlyMax')}, {rounded('avg(l_extendedprice)', 'ShadowPrice_HourlyAvg')},
          {rounded('avg(l_quantity)', 'ConstraintLimit_HourlyAvg')}, {rounded('avg(l_discount)', 'ConstraintFlow_HourlyAvg')},
          {rounded('max(l_tax)', 'ConstraintViolation_HourlyMax')}, count(*) AS n_intervals FROM lineitem GROUP BY 1, 2""",
)
def constraint_hourly(t: Tables) -> DataFrame:
    return P.constraints(t.line_constraints)


@query("hourly_mean_global", f"SELECT TimestampHour, {rounded_all(SOLAR_5MIN_COLUMNS)} FROM hourly_s5")
def hourly_mean_global(t: Tables) -> DataFrame:
    return P.solar_5min(t.market.read(t.spark, "solar_5min"))


@query(
    "distinct_counts",
    """SELECT count(DISTINCT l_suppkey) AS n_l_suppkey, count(DISTINCT l_partkey) AS n_l_partkey, count(DISTINCT l_shipdate) AS n_l_shipdate
       FROM lineitem""",
)
def distinct_counts(t: Tables) -> DataFrame:
    return A.distinct_counts(t["lineitem"], ["l_suppkey", "l_partkey", "l_shipdate"])


@query(
    "date_range",
    """SELECT min(ts) AS first_ts, max(ts) AS last_ts, CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0) AS BIGINT) AS span_days
       FROM events""",
)
def date_range(t: Tables) -> DataFrame:
    return A.date_range(t["events"], "ts")


@query(
    "value_counts_top",
    "SELECT l_suppkey, count(*) AS n_rows FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def value_counts_top(t: Tables) -> DataFrame:
    return A.value_counts(t["lineitem"], "l_suppkey")


@query(
    "union_chunks",
    "SELECT event_type, count(*) AS n_rows, round(sum(value), 6) AS total FROM (SELECT * FROM events WHERE value < 50 "
    "UNION ALL SELECT * FROM events WHERE value >= 50) AS a GROUP BY 1",
)
def union_chunks(t: Tables) -> DataFrame:
    low, high = (t["events"].filter(c) for c in (F.col("value") < 50, F.col("value") >= 50))
    return J.union_chunks([low, high]).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total"))


