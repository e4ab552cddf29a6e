"""Wide/long reshaping of hourly tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourweave.functions.scalar import present, rename_select
from hourweave.functions.timeutil import HOUR

# fixed values: zone columns of the two load tables and regions of the wind table
FORECAST_ZONES = ("NORTH", "SOUTH", "WEST", "HOUSTON", "TOTAL")
WEATHER_ZONES = ("COAST", "EAST", "FAR_WEST", "NORTH", "NORTH_C", "SOUTHERN", "SOUTH_C", "WEST")
WIND_REGIONS = ("SOUTH_HOUSTON", "WEST", "NORTH")


def load_name(zone: Column, prefix: str = "Load") -> Column:
    return F.concat(F.lit(f"{prefix}_"), zone, F.lit("_Hourly"))


def melt(df: DataFrame, ids: Sequence[str], zones: Sequence[str], var: str = "Zone", value: str = "LoadValue") -> DataFrame:
    """Zone columns to rows; zones the table lacks are skipped."""
    return df.unpivot(list(ids), present(df, zones), var, value)


def first_value(value: str, order: Column) -> Column:
    """The first non-null value in `order`: what is first must not depend on row arrival."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), order))


def pivot_first(
    df: DataFrame, ids: Sequence[str], names: str, value: str, wanted: Sequence[str], order: Column
) -> DataFrame:
    """Rows to columns, first non-null value per cell. The column list is given, so no extra pass finds it."""
    columns = {name: F.when(F.col(names) == name, F.col(value)) for name in wanted}
    spread_out = df.filter(F.col(value).isNotNull()).withColumns(columns)
    return spread_out.groupBy(*ids).agg(*[first_value(name, order).alias(name) for name in wanted])


def zones_wide(df: DataFrame, zones: Sequence[str], prefix: str = "Load", ts: str = HOUR) -> DataFrame:
    """Melt and pivot composed: one row per hour, columns renamed, hours without any value dropped.

    Repeated hours (autumn clock change) keep the smallest first value per zone.
    """
    have = present(df, zones)
    return (
        df.filter(F.col(ts).isNotNull() & F.coalesce(*[F.col(z) for z in have]).isNotNull())
        .groupBy(ts)
        .agg(*[F.min(z).alias(f"{prefix}_{z}_Hourly") for z in have])
    )


def wind_mapping(regions: Sequence[str] = WIND_REGIONS) -> dict[str, str]:
    """Source column -> feature name, system wide first, then each region."""
    mapping = {
        "SYSTEM_WIDE_GEN": "Wind_Actual_System_Hourly",
        "SYSTEM_WIDE_HSL": "Wind_HSL_System_Hourly",
        "COP_HSL_SYSTEM_WIDE": "Wind_COP_HSL_System_Hourly",
        "STWPF_SYSTEM_WIDE": "Wind_Forecast_STWPF_System_Hourly",
        "WGRPP_SYSTEM_WIDE": "Wind_Forecast_WGRPP_System_Hourly",
    }
    measures = {"GEN": "Actual", "COP_HSL": "HSL", "STWPF": "Forecast_STWPF", "WGRPP": "Forecast_WGRPP"}
    for region in regions:
        for source, feature in measures.items():
            mapping[f"{source}_LZ_{region}"] = f"Wind_{feature}_{region}_Hourly"
    return mapping


SOLAR_MAPPING = {
    "SYSTEM_WIDE_GEN": "Solar_Actual_Hourly",
    "COP_HSL_SYSTEM_WIDE": "Solar_COP_HSL_Hourly",
    "STPPF_SYSTEM_WIDE": "Solar_Forecast_STPPF_Hourly",
    "PVGRPP_SYSTEM_WIDE": "Solar_Forecast_PVGRPP_Hourly",
    "SYSTEM_WIDE_HSL": "Solar_HSL_Hourly",
}


def regional_wide(df: DataFrame, mapping: Mapping[str, str], ts: str = HOUR) -> DataFrame:
    """System and regional columns of one table side by side: a single projection, no self-joins."""
    return rename_select(df, mapping, keep=[ts])
