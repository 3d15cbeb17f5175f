"""Schemas shared by sources, operators and sinks.

One constant describes the stored record.  Wall-clock times are
``TIMESTAMP_NTZ`` in UTC, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

INT = T.IntegerType()
TEXT = T.StringType()
WALL_CLOCK = T.TimestampNTZType()

# Parsed measures keep every digit of the source text; the sink narrows them.
WIDE = T.DecimalType(38, 18)
DEGREES = T.DecimalType(5, 2)
DERIVED = T.DecimalType(6, 2)


def _fields(*pairs: tuple[str, T.DataType]) -> list[T.StructField]:
    return [T.StructField(name, kind, True) for name, kind in pairs]


# Names and types of the stored record, in column order.
RECORD = T.StructType(
    _fields(
        ("id", T.LongType()),
        ("city", TEXT),
        ("country", TEXT),
        ("latitude", T.DecimalType(10, 8)),
        ("longitude", T.DecimalType(11, 8)),
        ("temperature", DEGREES),
        ("feels_like", DEGREES),
        ("temp_min", DEGREES),
        ("temp_max", DEGREES),
        ("humidity", INT),
        ("pressure", INT),
        ("sea_level", INT),
        ("ground_level", INT),
        ("wind_speed", DEGREES),
        ("wind_direction", INT),
        ("wind_gust", DEGREES),
        ("weather_main", TEXT),
        ("weather_description", TEXT),
        ("cloudiness", INT),
        ("visibility", INT),
        ("uv_index", T.DecimalType(3, 1)),
        ("sunrise_time", WALL_CLOCK),
        ("sunset_time", WALL_CLOCK),
        ("api_timestamp", WALL_CLOCK),
        ("recorded_at", WALL_CLOCK),
        ("created_at", WALL_CLOCK),
        ("updated_at", WALL_CLOCK),
        ("temperature_category", TEXT),
        ("heat_index", DERIVED),
        ("wind_category", TEXT),
        ("comfort_level", TEXT),
        ("data_quality_score", INT),
        ("processing_timestamp", WALL_CLOCK),
        ("temperature_fahrenheit", DERIVED),
        ("weather_severity_index", INT),
        ("is_extreme", T.BooleanType()),
        ("recommendation", TEXT),
    )
)

# Longest text the stored table takes, per column.
TEXT_LIMITS = {
    "city": 100,
    "country": 10,
    "weather_main": 50,
    "weather_description": 200,
}

# Inclusive ranges the stored table enforces; NULL passes.
RANGES = {
    "humidity": (0, 100),
    "wind_direction": (0, 360),
    "cloudiness": (0, 100),
}

# Raw responses as they land.
LANDING = T.StructType(
    _fields(
        ("kind", TEXT),
        ("city", TEXT),
        ("request_url", TEXT),
        ("status", INT),
        ("body", TEXT),
        ("fetched_at", WALL_CLOCK),
        # Names the fetch cycle: a record takes the UV reading of its own cycle.
        ("cycle", TEXT),
    )
)

# JSON bodies.  Numbers are read as wide decimals straight from their token, and
# from text that holds a number; anything else is NULL and spoils no sibling.
_N = WIDE.simpleString()
_COORD = f"struct<lat:{_N},lon:{_N}>"
_MAIN = "struct<{}>".format(
    ",".join(
        f"{name}:{_N}"
        for name in (
            "temp", "feels_like", "temp_min", "temp_max", "humidity", "pressure", "sea_level",
            "grnd_level",
        )
    )
)
_WIND = f"struct<speed:{_N},deg:{_N},gust:{_N}>"
_WEATHER = "array<struct<main:string,description:string>>"
_CLOUDS = f"struct<`all`:{_N}>"
_SUN = f"sunrise:{_N},sunset:{_N}"
_CITY = f"struct<name:string,country:string,coord:{_COORD},{_SUN}>"
_ENTRY = (
    f"main {_MAIN}, wind {_WIND}, weather {_WEATHER}, clouds {_CLOUDS}, visibility {_N}, dt {_N}"
)
_OWN_PLACE = f"name string, sys struct<country:string,{_SUN}>, coord {_COORD}"
_ENTRIES = (
    f"list array<struct<main:{_MAIN},wind:{_WIND},weather:{_WEATHER},clouds:{_CLOUDS},"
    f"visibility:{_N},dt:{_N}>>"
)

CURRENT_BODY = f"{_OWN_PLACE}, city {_CITY}, {_ENTRY}"
FORECAST_BODY = f"city {_CITY}, {_ENTRIES}"
RECORD_BODY = f"{_OWN_PLACE}, city {_CITY}, {_ENTRY}, {_ENTRIES}"
UV_BODY = f"value {_N}"
