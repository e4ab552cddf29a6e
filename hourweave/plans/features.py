"""Raw feeds to the unified (hour, entity) feature table, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourweave.functions.scalar import DAM, RTM, RTM_ALT, rename_select
from hourweave.functions.timeutil import HOUR, KEY, deliverydate_to_hour, interval_to_hour, operday_to_hour
from hourweave.operators.aggregates import constraint_hourly, constraint_system, hourly_mean
from hourweave.operators.joins import HourRange, join_hourly, outer_join, stack_join, stored_within, union_chunks, within
from hourweave.operators.reshape import (
    FORECAST_ZONES, SOLAR_MAPPING, WEATHER_ZONES, regional_wide, wind_mapping, zones_wide,
)
from hourweave.sources.readers import Market

SOLAR_5MIN = {"SYSTEM_WIDE_GEN": "Solar_Actual_5min_Hourly", "SYSTEM_WIDE_HSL": "Solar_HSL_5min_Hourly"}
DELIVERY_NAMES = {"DELIVERY_DATE": "DeliveryDate", "HOUR_ENDING": "HourEnding"}


def dam_prices(raw: DataFrame) -> DataFrame:
    """Day-ahead prices per hour and entity."""
    return rename_select(deliverydate_to_hour(raw), {"SettlementPointPrice": DAM}, keep=[HOUR, KEY])


def realtime_prices(raw: DataFrame, out: str = RTM) -> DataFrame:
    """Hourly mean of a 5-minute price feed."""
    return hourly_mean(interval_to_hour(raw, "SCEDTimestamp"), {"LMP": out})


def realtime_prices_both(raw: DataFrame, alternative: DataFrame) -> DataFrame:
    """Hourly means of both real-time feeds, as their full outer join would give them.

    Each side has one row per hour and entity, so stacking the feeds and averaging once gives
    the same rows with a single shuffle of partial sums instead of two and a join.
    """
    feeds = [
        raw.select("SCEDTimestamp", KEY, F.col("LMP").alias(RTM)),
        alternative.select("SCEDTimestamp", KEY, F.col("LMP").alias(RTM_ALT)),
    ]
    return hourly_mean(interval_to_hour(union_chunks(feeds), "SCEDTimestamp"), {RTM: RTM, RTM_ALT: RTM_ALT})


def forecast_zone_load(raw: DataFrame) -> DataFrame:
    return zones_wide(operday_to_hour(raw), FORECAST_ZONES, "LoadFZ")


def weather_zone_load(raw: DataFrame) -> DataFrame:
    """Prefixed on its own: two zone names also occur among the forecast zones."""
    return zones_wide(operday_to_hour(raw), WEATHER_ZONES, "LoadWZ")


def solar_5min(raw: DataFrame) -> DataFrame:
    return hourly_mean(interval_to_hour(raw, "INTERVAL_ENDING"), SOLAR_5MIN, key=[])


def solar_hourly(raw: DataFrame) -> DataFrame:
    return regional_wide(deliverydate_to_hour(raw.withColumnsRenamed(DELIVERY_NAMES)), SOLAR_MAPPING)


def wind_hourly(raw: DataFrame) -> DataFrame:
    return regional_wide(deliverydate_to_hour(raw.withColumnsRenamed(DELIVERY_NAMES)), wind_mapping())


def constraints(raw: DataFrame) -> DataFrame:
    return constraint_hourly(interval_to_hour(raw, "SCEDTimeStamp"))


#: The column that holds a feed's time or day.
STORED_TIME = {
    "dam": "DeliveryDate", "rtm": "SCEDTimestamp", "rtm_alt": "SCEDTimestamp", "load_forecast_zone": "OperDay", "load_weather_zone": "OperDay",
    "solar_5min": "INTERVAL_ENDING", "solar_hourly": "DELIVERY_DATE", "wind_hourly": "DELIVERY_DATE", "constraints": "SCEDTimeStamp",
}


def _feed(spark: SparkSession, market: Market, role: str, span: HourRange | None) -> DataFrame:
    return stored_within(market.read(spark, role), span, STORED_TIME[role])


def price_panel(spark: SparkSession, market: Market, span: HourRange | None = None) -> DataFrame:
    """Day-ahead, real-time and alternative real-time prices on one grain."""
    feeds = [
        dam_prices(_feed(spark, market, "dam", span)),
        realtime_prices_both(_feed(spark, market, "rtm", span), _feed(spark, market, "rtm_alt", span)),
    ]
    return outer_join([within(f, span) for f in feeds])


def hourly_globals(spark: SparkSession, market: Market, span: HourRange | None = None) -> list[DataFrame]:
    made = {
        "load_forecast_zone": forecast_zone_load, "load_weather_zone": weather_zone_load, "solar_5min": solar_5min,
        "solar_hourly": solar_hourly, "wind_hourly": wind_hourly,
    }
    return [make(_feed(spark, market, role, span)) for role, make in made.items()]


def unified_features(
    spark: SparkSession, market: Market, span: HourRange | None = None, with_constraints: bool = False
) -> DataFrame:
    """One row per hour and entity: prices, load, solar and wind, optionally system-wide constraints.

    `span` limits the hours; it bounds the stored time or day of every feed, so scans are pruned,
    and makes the hour-grain side of the join, one row per hour, small enough to broadcast.
    """
    tables = hourly_globals(spark, market, span)
    if with_constraints:
        tables.append(constraint_system(constraints(_feed(spark, market, "constraints", span))))
    return join_hourly(price_panel(spark, market, span), tables, span)


def hourly_solar_wind(spark: SparkSession, market: Market) -> DataFrame:
    """Fan-in of the three solar and wind tables on the hour, in one shuffle; an hour that tables repeat is one row."""
    return stack_join(hourly_globals(spark, market)[2:], on=[HOUR])
