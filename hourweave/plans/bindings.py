"""Market feeds bound to the driver's tables.

`events` plays the sub-hourly feeds: `value` is the price or output, the number in `props`
a second measure, `event_type` the entity or zone. The day-ahead price of an hour is the
mean of the same hour the day before, so first and last day lack one of the two prices.
All feeds read the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourweave.functions.scalar import spread
from hourweave.operators.ranking import chronological_split
from hourweave.plans.features import price_panel, unified_features
from hourweave.session import materialise
from hourweave.sources.readers import Market, json_number, read_parquet

# fixed values: which event type stands for which zone or region
FORECAST_ZONE_OF = {"NORTH": "click", "SOUTH": "view", "WEST": "error", "HOUSTON": "signup"}
WEATHER_ZONE_OF = {"COAST": "click", "EAST": "view", "FAR_WEST": "error", "NORTH": "signup", "WEST": "purchase"}
WIND_REGION_OF = {"SOUTH_HOUSTON": "click", "WEST": "view", "NORTH": "purchase"}


def hour_label() -> Column:
    return F.concat(F.lpad((F.hour("ts") + 1).cast("string"), 2, "0"), F.lit(":00"))


def _sum_of(kind: str, value: str) -> Column:
    return F.sum(F.when(F.col("event_type") == kind, F.col(value)))


@dataclass(frozen=True)
class Tables:
    """The driver's tables and what is derived from them."""

    spark: SparkSession
    sf_dir: str
    _read: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = read_parquet(self.spark, f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def where(self, name: str, condition: Column) -> DataFrame:
        """Rows of a table that meet a condition, filtered at the scan."""
        return read_parquet(self.spark, f"{self.sf_dir}/{name}.parquet", where=condition)

    @cached_property
    def events(self) -> DataFrame:
        return self["events"].withColumn("k", json_number("props", "k"))

    @cached_property
    def events_by_hour(self) -> DataFrame:
        return self.events.withColumns({"day": F.col("ts").cast("date"), "label": hour_label()})

    @cached_property
    def market(self) -> Market:
        return self._market(self.events_by_hour)

    def _market(self, e: DataFrame) -> Market:
        hourly = e.groupBy(F.col("day").alias("DELIVERY_DATE"), F.col("label").alias("HOUR_ENDING"))
        load = e.groupBy(F.col("day").alias("OperDay"), F.col("label").alias("HourEnding"))
        lmp = [F.col("ts").alias("SCEDTimestamp"), F.col("event_type").alias("SettlementPoint")]
        return Market("events", {
            "load_forecast_zone": lambda: load.agg(
                *[_sum_of(kind, "value").alias(zone) for zone, kind in FORECAST_ZONE_OF.items()], F.sum("value").alias("TOTAL")
            ),
            "load_weather_zone": lambda: load.agg(*[_sum_of(kind, "k").alias(zone) for zone, kind in WEATHER_ZONE_OF.items()]),
            "dam": lambda: e.groupBy(
                F.date_add("day", 1).alias("DeliveryDate"), F.col("label").alias("HourEnding"), F.col("event_type").alias("SettlementPoint")
            ).agg(F.avg("value").alias("SettlementPointPrice")),
            "rtm": lambda: e.select(*lmp, F.col("value").alias("LMP")),
            "rtm_alt": lambda: e.select(*lmp, F.col("k").alias("LMP")),
            "constraints": lambda: e.select(
                F.col("ts").alias("SCEDTimeStamp"), F.concat(F.lit("c"), F.col("user_id")).alias("ConstraintName"),
                F.col("value").alias("ShadowPrice"), F.col("k").alias("Limit"), (F.col("value") + F.col("k")).alias("Value"),
                (F.col("value") - F.col("k")).alias("ViolatedMW"),
            ),
            "solar_5min": lambda: e.select(
                F.col("ts").alias("INTERVAL_ENDING"), F.col("value").alias("SYSTEM_WIDE_GEN"), F.col("k").alias("SYSTEM_WIDE_HSL")
            ),
            "solar_hourly": lambda: hourly.agg(
                F.sum("value").alias("SYSTEM_WIDE_GEN"), F.sum("k").alias("COP_HSL_SYSTEM_WIDE"), F.avg("value").alias("STPPF_SYSTEM_WIDE"),
                F.avg("k").alias("PVGRPP_SYSTEM_WIDE"), F.max("value").alias("SYSTEM_WIDE_HSL"),
            ),
            "wind_hourly": lambda: hourly.agg(
                F.sum("value").alias("SYSTEM_WIDE_GEN"), F.sum(F.col("value") + F.col("k")).alias("SYSTEM_WIDE_HSL"),
                *[_sum_of(kind, "value").alias(f"GEN_LZ_{region}") for region, kind in WIND_REGION_OF.items()],
            ),
        })

    @cached_property
    def line_constraints(self) -> DataFrame:
        """Constraint feed over every line item: ship date as interval, supplier as constraint."""
        return self["lineitem"].select(
            F.col("l_shipdate").alias("SCEDTimeStamp"), F.col("l_suppkey").cast("string").alias("ConstraintName"),
            F.col("l_extendedprice").alias("ShadowPrice"), F.col("l_quantity").alias("Limit"),
            F.col("l_discount").alias("Value"), F.col("l_tax").alias("ViolatedMW"),
        )

    @cached_property
    def daily_panel(self) -> DataFrame:
        """Log of the mean order price per day and priority: a long panel for rolling windows."""
        return self["orders"].groupBy(F.col("o_orderdate").alias("TimestampHour"), F.col("o_orderpriority").alias("SettlementPoint")).agg(
            F.log(F.avg("o_totalprice")).alias("y")
        )

    @cached_property
    def panel(self) -> DataFrame:
        return price_panel(self.spark, self.market)

    @cached_property
    def unified(self) -> DataFrame:
        return unified_features(self.spark, self.market)

    @cached_property
    def spread(self) -> DataFrame:
        return spread(self.panel)

    @cached_property
    def panel_table(self) -> DataFrame:
        """The price panel, written once, for jobs that go over it several times."""
        return materialise(self.panel, "panel")

    @cached_property
    def stored_spread(self) -> DataFrame:
        return spread(self.panel_table)

    @cached_property
    def unified_table(self) -> DataFrame:
        """The feature table as the jobs after the feature build see it: written once, read often.

        Events are parsed and written once before, since each of the feeds goes over all of them.
        """
        parsed = self.events_by_hour.select("ts", "user_id", "event_type", "value", "k", "day", "label")
        return materialise(unified_features(self.spark, self._market(materialise(parsed, "events"))), "features")

    @cached_property
    def split(self) -> DataFrame:
        """Split price panel, stored as well: fits and metrics read it several times."""
        return materialise(chronological_split(self.stored_spread), "split")
