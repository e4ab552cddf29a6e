"""Queries over sources, sinks, column roles and registries: what is written is read back and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourweave.functions import scalar as S
from hourweave.functions.timeutil import HOUR, KEY
from hourweave.operators import prep, quality
from hourweave.plans.bindings import Tables
from hourweave.plans.dataset import prepare
from hourweave.plans.oracle import PRICE_COLUMNS, rounded_all
from hourweave.plans.registry import query
from hourweave.session import materialise, scratch_path
from hourweave.sources import sinks
from hourweave.sources.readers import Markets, read_parquet
from hourweave.streaming import incremental

GRAIN = "TimestampHour, SettlementPoint"


@query("nested_roots", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def nested_roots(t: Tables) -> DataFrame:
    """Two roots with folders below, found recursively by a file pattern."""
    root = scratch_path(t.spark, "roots")
    rows = t["orders"].select("o_orderkey", "o_orderstatus", "o_totalprice")
    finished = F.col("o_orderstatus") == "F"
    rows.filter(finished).write.parquet(f"{root}/one/deep/er")
    rows.filter(~finished | finished.isNull()).write.parquet(f"{root}/two")
    return read_parquet(t.spark, [f"{root}/one", f"{root}/two"], recursive=True, pattern="*.parquet")


@query("ordered_parquet", f"SELECT {GRAIN}, {rounded_all(PRICE_COLUMNS)}, true AS in_order FROM panel")
def ordered_parquet(t: Tables) -> DataFrame:
    """Every row read back, with whether its file's hours end before the next file's begin."""
    path = scratch_path(t.spark, "ordered")
    sinks.write_ordered(t.panel, path)
    stored = t.spark.read.parquet(path)
    # one row for each file
    spans = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(HOUR).alias("first"), F.max(HOUR).alias("last"))
    listed = spans.agg(F.sort_array(F.collect_list(F.struct("file", "first", "last"))).alias("f"))
    pairs = F.zip_with(F.slice("f", 1, F.size("f") - 1), F.slice("f", 2, F.size("f") - 1), lambda a, b: a["last"] <= b["first"])
    return S.attach_row(stored, listed.select(F.forall(pairs, lambda x: x).alias("ok")), "_o").withColumn("in_order", F.col("_o.ok")).drop("_o")


def _scored(t: Tables) -> DataFrame:
    return sinks.prediction_rows(t.spread.select(HOUR, KEY, F.col(S.SPREAD).alias("prediction")), model_type="spread")


SCORED = "SELECT TimestampHour, SettlementPoint, DART AS DART_Prediction, 'spread' AS ModelType FROM splits"


@query("catalog_table_append", f"SELECT *, CAST(2 AS BIGINT) AS n_rows FROM ({SCORED}) AS s".replace("DART AS DART_Prediction", "round(DART, 6) AS DART_Prediction"))
def catalog_table_append(t: Tables) -> DataFrame:
    """Appended twice to a new table of the catalog: every row is there twice."""
    table = f"scores_{uuid.uuid4().hex}"
    for _ in range(2):
        sinks.append_table(_scored(t), table)
    stored = t.spark.table(table).withColumn("DART_Prediction", F.round("DART_Prediction", 6))
    return materialise(stored.groupBy(HOUR, KEY, "DART_Prediction", "ModelType").agg(F.count(F.lit(1)).alias("n_rows")), "appended")


@query("csv_round_trip", f"SELECT {GRAIN}, round(DART_Prediction, 6) AS DART_Prediction, ModelType FROM ({SCORED}) AS s")
def csv_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    scored = _scored(t)
    sinks.write_csv(scored, path)
    return t.spark.read.schema(scored.schema).csv(path, header=True)


@query("market_registry", "SELECT event_type AS SettlementPoint, count(*) AS n_rows, round(sum(value), 4) AS total FROM events GROUP BY 1")
def market_registry(t: Tables) -> DataFrame:
    """The real-time feed of a market found by its name."""
    feed = Markets([t.market])["events"].read(t.spark, "rtm")
    return feed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("LMP"), 4).alias("total"))


@query("fitted_round_trip", f"SELECT feature, {rounded_all(['mean', 'std'])} FROM scaling")
def fitted_round_trip(t: Tables) -> DataFrame:
    """Scaling parameters stored and loaded again."""
    path = scratch_path(t.spark, "fitted")
    sinks.save_fitted(path, {"scaling": prepare(t.unified_table, store=materialise)[1].scaling})
    return sinks.load_params(t.spark, path, "scaling")


@query("nan_to_null", "SELECT event_id, CASE WHEN value >= 50 THEN round(value, 6) END AS value FROM events")
def nan_to_null(t: Tables) -> DataFrame:
    """NaN written for small values comes back as null."""
    path = scratch_path(t.spark, "nan")
    t["events"].select("event_id", F.when(F.col("value") >= 50, F.col("value")).otherwise(F.lit(float("nan"))).alias("value")).write.parquet(path)
    return read_parquet(t.spark, path)


@query(
    "column_roles",
    """SELECT 'Zone' AS name, CASE WHEN count(DISTINCT s_nationkey) < 50 THEN 'categorical' ELSE 'continuous' END AS role FROM supplier
       UNION ALL SELECT 'Settlement', CASE WHEN count(DISTINCT s_suppkey) < 0 THEN 'categorical' ELSE 'continuous' END FROM supplier
       UNION ALL SELECT 's_name', 'categorical'""",
)
def column_roles(t: Tables) -> DataFrame:
    """A numeric zone of few values, a number, a string."""
    rows = t["supplier"].select(F.col("s_nationkey").alias("Zone"), F.col("s_suppkey").alias("Settlement"), "s_name")
    roles = prep.feature_roles(rows)
    found = [(c, "categorical") for c in roles.categorical] + [(c, "continuous") for c in roles.continuous]
    return t.spark.createDataFrame(found, "name string, role string")


@query(
    "numeric_features",
    """SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity', 'l_discount', 'l_tax']) AS feature
       WHERE (SELECT count(*) FROM lineitem WHERE l_extendedprice IS NULL) = 0""",
)
def numeric_features(t: Tables) -> DataFrame:
    """All numeric columns but a target, once that has no nulls."""
    names = prep.numeric_features(t["lineitem"], "l_extendedprice")
    return t.spark.createDataFrame([(n,) for n in names], "feature string")


@query("required_columns", "SELECT l_returnflag, count(*) AS n_rows FROM lineitem GROUP BY 1")
def required_columns(t: Tables) -> DataFrame:
    """Counts of a table that has been found to have rows and the columns asked for."""
    quality.require_columns(t["lineitem"], ["l_returnflag", "l_shipdate"])
    return t["lineitem"].groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"))


@query("column_difference", "SELECT unnest(['Load', 'Wind']) AS missing, count(*) AS n_rows FROM orders")
def column_difference(t: Tables) -> DataFrame:
    """Wanted columns that a table lacks, beside its number of rows."""
    lacking = S.missing_features(t["orders"], ["O_ORDERKEY", "Load", "o_totalprice", "Wind"])
    return t["orders"].agg(F.count(F.lit(1)).alias("n_rows")).select(F.explode(F.array(*[F.lit(c) for c in lacking])).alias("missing"), "n_rows")


@query(
    "stream_publish",
    f"""SELECT {GRAIN}, {rounded_all(['RTM_LMP_HourlyAvg'])}, year(TimestampHour) AS "year", month(TimestampHour) AS "month", day(TimestampHour) AS "day",
          hour(TimestampHour) AS "hour" FROM rtm WHERE TimestampHour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def stream_publish(t: Tables) -> DataFrame:
    """Hourly means published by closed window into hour folders."""
    feed = incremental.read_feed(t.spark, t.sf_dir, t.spark.read.parquet(f"{t.sf_dir}/events.parquet").schema, pattern="events.parquet")
    means = incremental.hourly_mean_stream(feed.withColumnRenamed("event_type", KEY), "ts", "value", S.RTM)
    path = scratch_path(t.spark, "stream-published")
    incremental.publish_stream(means, path, scratch_path(t.spark, "stream-state")).awaitTermination()
    return t.spark.read.parquet(path)
