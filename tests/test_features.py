"""Feature build on hand-written feeds: absent feeds, null keys, repeated hours, name clashes."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hourweave.operators import aggregates as A
from hourweave.operators import joins as J
from hourweave.operators import reshape as R
from hourweave.plans import bindings
from hourweave.plans import features as P
from hourweave.plans.registry import comparable
from hourweave.sources.readers import Market, Markets, request_rows
from hourweave.sources.schemas import FEEDS

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def market(spark, hour):
    five = dt.timedelta(minutes=5)
    dam = [(hour(0), "01:00", "hub", 30.0), (hour(5), "02:00", "hub", 40.0), (hour(0), None, "hub", 99.0), (hour(0), "01:00", None, 1.0)]
    rtm = [(hour(0), "hub", 10.0), (hour(0) + five, "hub", 20.0), (hour(0) + 2 * five, "hub", float("nan")), (hour(2), "node", 7.0), (hour(0), None, 5.0)]
    load = [(DAY, "1", 1.0, 2.0, None, 4.0, 7.0), (DAY, "2", None, None, None, None, None), (DAY, "3", 5.0, 6.0, 7.0, 8.0, 26.0), (DAY, "3", 50.0, 60.0, 70.0, 80.0, 260.0)]
    wind = [(DAY, "1", 100.0, 40.0), (DAY, "2", 200.0, 80.0), (DAY, "2", 210.0, 90.0)]
    return Market("toy", {
        "dam": lambda: spark.createDataFrame(dam, FEEDS["dam"]),
        "rtm": lambda: spark.createDataFrame(rtm, FEEDS["rtm"]),
        "load_forecast_zone": lambda: spark.createDataFrame(load, FEEDS["load_forecast_zone"]),
        "wind_hourly": lambda: spark.createDataFrame(wind, "DELIVERY_DATE date, HOUR_ENDING string, SYSTEM_WIDE_GEN double, GEN_LZ_WEST double"),
    })


def test_price_panel(spark, hour, market):
    rows = {(r.TimestampHour, r.SettlementPoint): (r.DAM_Price_Hourly, r.RTM_LMP_HourlyAvg, r.RTM_LMP_HourlyAvg_Alt) for r in P.price_panel(spark, market).collect()}
    assert rows == {(hour(0), "hub"): (30.0, 15.0, None), (hour(1), "hub"): (40.0, None, None), (hour(2), "node"): (None, 7.0, None)}


def test_load_drops_empty_hours_and_settles_repeats(spark, hour, market):
    rows = {r.TimestampHour: r for r in P.forecast_zone_load(market.read(spark, "load_forecast_zone")).collect()}
    assert set(rows) == {hour(0), hour(2)}
    assert (rows[hour(0)].LoadFZ_NORTH_Hourly, rows[hour(0)].LoadFZ_WEST_Hourly) == (1.0, None)
    assert rows[hour(2)].LoadFZ_TOTAL_Hourly == 26.0


def test_wind_keeps_one_row_per_input_row(spark, market):
    out = P.wind_hourly(market.read(spark, "wind_hourly"))
    assert out.columns == ["TimestampHour", "Wind_Actual_System_Hourly", "Wind_Actual_WEST_Hourly"]
    assert out.count() == 3


def test_unified_keeps_declared_columns_of_absent_feeds(spark, hour, market):
    once = Market("once", {k: v for k, v in market.feeds.items() if k != "wind_hourly"})
    out = P.unified_features(spark, once, with_constraints=True)
    assert {"LoadWZ_COAST_Hourly", "Solar_HSL_5min_Hourly", "Wind_HSL_WEST_Hourly", "System_ShadowPrice_Max"} <= set(out.columns)
    assert out.count() == 3
    row = out.filter((F.col("TimestampHour") == hour(0)) & (F.col("SettlementPoint") == "hub")).first()
    assert (row.LoadFZ_NORTH_Hourly, row.LoadWZ_COAST_Hourly) == (1.0, None)


def test_hour_range(spark, hour, market):
    out = P.unified_features(spark, market, span=(hour(0), hour(1)))
    assert [(r.TimestampHour, r.SettlementPoint) for r in out.collect()] == [(hour(0), "hub")]


def test_ambiguous_names_are_refused(spark, hour):
    a = spark.createDataFrame([(hour(0), 1.0)], "TimestampHour timestamp_ntz, x double")
    with pytest.raises(ValueError, match="ambiguous"):
        J.join_hourly(a.withColumnRenamed("x", "y"), [a, a.withColumnRenamed("x", "X")])


def test_null_keys_never_match(spark, hour):
    rows = [(hour(0), None, 1.0), (None, "a", 1.0), (hour(0), "a", 1.0)]
    a = spark.createDataFrame(rows, "TimestampHour timestamp_ntz, SettlementPoint string, x double")
    assert J.outer_join([a, a.withColumnRenamed("x", "y")]).count() == 1


def test_melt_and_pivot_skip_nulls(spark):
    df = spark.createDataFrame([(1, 5.0, None), (2, None, 8.0)], "h int, NORTH double, WEST double")
    long = R.melt(df, ["h"], ["NORTH", "WEST", "ABSENT"])
    assert long.count() == 4
    wide = R.pivot_first(long.withColumn("o", F.col("h")), ["h"], "Zone", "LoadValue", ["WEST", "NORTH"], F.col("o"))
    assert {tuple(r) for r in wide.collect()} == {(1, None, 5.0), (2, 8.0, None)}


def test_constraints_tolerate_absent_columns(spark, hour):
    df = spark.createDataFrame(
        [(hour(0), "c1", 5.0), (hour(0), "c1", 7.0), (hour(0), "c2", 100.0), (hour(0), None, 1.0)],
        "TimestampHour timestamp_ntz, ConstraintName string, ShadowPrice double",
    )
    out = A.constraint_hourly(df)
    assert out.columns == ["TimestampHour", "ConstraintName", "ShadowPrice_HourlyMax", "ShadowPrice_HourlyAvg", "n_intervals"]
    system = A.constraint_system(out.withColumn("ConstraintViolation_HourlyMax", F.lit(1.0))).first()
    assert (system.System_ShadowPrice_Max, system.Binding_Constraints) == (100.0, 2)
    assert system.System_ShadowPrice_Avg == pytest.approx(112 / 3)


def test_markets_by_name(spark, market, tmp_path):
    markets = Markets([market])
    markets.register(Market("empty", {"rtm_alt": str(tmp_path / "absent"), "rtm": str(tmp_path / "absent"), "dam": "no_such_table"}))
    assert markets["empty"].read(spark, "rtm_alt").schema == FEEDS["rtm_alt"]
    assert markets["empty"].read(spark, "wind_hourly").isEmpty()
    for named in ("rtm", "dam"):
        with pytest.raises(AnalysisException):
            markets["empty"].read(spark, named)
    with pytest.raises(KeyError, match="toy"):
        markets["other"]


def test_requests(spark, hour):
    text = '{"data": [{"TimestampHour": "2024-01-01 00:00:00", "SettlementPoint": "hub", "x": 2.5}, {"SettlementPoint": "node"}]}'
    rows = request_rows(spark.createDataFrame([(text,)], "value string"), ["x", "y"]).collect()
    assert [tuple(r) for r in rows] == [(hour(0), "hub", 2.5, None), (None, "node", None, None)]


def test_repeated_hours_do_not_multiply_the_panel(spark, hour):
    panel = spark.createDataFrame([(hour(0), "a"), (hour(0), "b")], "TimestampHour timestamp_ntz, SettlementPoint string")
    wind = spark.createDataFrame([(hour(0), 2.0), (hour(0), 1.0), (hour(0), None)], "TimestampHour timestamp_ntz, w double")
    load = spark.createDataFrame([(hour(0), 5.0), (None, 6.0)], "TimestampHour timestamp_ntz, l double")
    rows = J.join_hourly(panel, [wind, load]).collect()
    assert sorted((r.SettlementPoint, r.w, r.l) for r in rows) == [("a", 1.0, 5.0), ("b", 1.0, 5.0)]


def test_hour_range_reaches_every_scan(spark, hour, market, tmp_path):
    stored = {}
    for role in P.STORED_TIME:
        path = str(tmp_path / role)
        market.read(spark, role).write.parquet(path)
        stored[role] = path
    named = Market("stored", stored)
    for span in ((hour(0), hour(1)), (hour(1), hour(3)), (hour(23), hour(30))):
        out = P.unified_features(spark, named, span=span, with_constraints=True)
        whole = P.unified_features(spark, named, with_constraints=True).filter((F.col("TimestampHour") >= span[0]) & (F.col("TimestampHour") < span[1]))
        assert out.exceptAll(whole).isEmpty() and out.count() == whole.count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == len(P.STORED_TIME)
    assert all("GreaterThanOrEqual" in line and "LessThan" in line for line in scans)


def test_fan_in_keeps_one_row_per_repeated_hour(spark):
    """An autumn hour that two tables hold twice and thrice is one row, with the smallest value of each column."""
    schema = "DELIVERY_DATE timestamp_ntz, HOUR_ENDING string, SYSTEM_WIDE_GEN double"
    day = dt.datetime(2024, 11, 3)
    solar = spark.createDataFrame([(day, "02:00", 5.0), (day, "02:00", 4.0), (day, "03:00", 1.0)], schema)
    wind = spark.createDataFrame([(day, "02:00", 9.0), (day, "02:00", 7.0), (day, "02:00", 8.0)], schema)
    market = Market("m", {"solar_hourly": lambda: solar, "wind_hourly": lambda: wind})
    got = {r.TimestampHour.hour: (r.Solar_Actual_Hourly, r.Wind_Actual_System_Hourly) for r in P.hourly_solar_wind(spark, market).collect()}
    assert got == {1: (4.0, 7.0), 2: (1.0, None)}


def test_feature_table_parses_events_once(spark, monkeypatch):
    """Every feed of the stored feature table reads one parsed copy of the events."""
    plans, store = [], bindings.materialise
    monkeypatch.setattr(bindings, "materialise", lambda df, label: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or store(df, label))
    tables = bindings.Tables(spark, "/root/testdata/sf0.001")
    assert not comparable(tables.unified_table).exceptAll(comparable(tables.unified)).count()
    assert [plan.count("from_json") for plan in plans] == [1, 0]
