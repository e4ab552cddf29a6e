"""Declared schemas of the feeds, so reads need no inference and absent feeds have a shape."""

from __future__ import annotations

from pyspark.sql import types as T

from hourweave.operators.reshape import FORECAST_ZONES, SOLAR_MAPPING, WEATHER_ZONES, wind_mapping


def _table(*fixed: tuple[str, T.DataType], doubles: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType(
        [T.StructField(n, t) for n, t in fixed] + [T.StructField(n, T.DoubleType()) for n in doubles]
    )


_NTZ, _DATE, _TEXT = T.TimestampNTZType(), T.DateType(), T.StringType()
_LMP = _table(("SCEDTimestamp", _NTZ), ("SettlementPoint", _TEXT), doubles=("LMP",))

# role -> schema of the feed that fills it
FEEDS: dict[str, T.StructType] = {
    "load_forecast_zone": _table(("OperDay", _DATE), ("HourEnding", _TEXT), doubles=FORECAST_ZONES),
    "load_weather_zone": _table(("OperDay", _DATE), ("HourEnding", _TEXT), doubles=WEATHER_ZONES),
    "dam": _table(("DeliveryDate", _NTZ), ("HourEnding", _TEXT), ("SettlementPoint", _TEXT), doubles=("SettlementPointPrice",)),
    "rtm": _LMP,
    "rtm_alt": _LMP,
    "constraints": _table(
        ("SCEDTimeStamp", _NTZ), ("ConstraintName", _TEXT), doubles=("ShadowPrice", "Limit", "Value", "ViolatedMW")
    ),
    "solar_5min": _table(("INTERVAL_ENDING", _NTZ), doubles=("SYSTEM_WIDE_GEN", "SYSTEM_WIDE_HSL")),
    "solar_hourly": _table(("DELIVERY_DATE", _DATE), ("HOUR_ENDING", _TEXT), doubles=tuple(SOLAR_MAPPING)),
    "wind_hourly": _table(("DELIVERY_DATE", _DATE), ("HOUR_ENDING", _TEXT), doubles=tuple(wind_mapping())),
}

PREDICTIONS = T.StructType([
    T.StructField("TimestampHour", _NTZ),
    T.StructField("SettlementPoint", _TEXT),
    T.StructField("DART_Prediction", T.DoubleType()),
    T.StructField("ModelType", _TEXT),
])
