"""Raw JSON responses to typed records.

Each parser replaces the landing's ``city`` by the record's columns, keeps the
other landing columns and adds ``parse_error``.  A bad leaf is NULL and its
siblings survive; only text that is not JSON at all sets ``parse_error``.  An
explicit JSON null counts as absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import schemas
from skyledger.functions import casts
from skyledger.functions.text import url_param
from skyledger.sources.landing import FORECAST

CORRUPT = "_corrupt"
MALFORMED = "malformed body"

# Decimal places of a coordinate inside a request URL, hence of the lookup key.
COORDINATE_KEY = "decimal(10,6)"

_ENTRY_FIELDS = ("main", "wind", "weather", "clouds", "visibility", "dt")


def _read_body(body: Column, schema: str) -> Column:
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "allowSingleQuotes": "false",
        "allowNonNumericNumbers": "false",
    }
    return F.from_json(body, f"{schema}, {CORRUPT} string", options)


def _malformed(parsed: Column) -> Column:
    """NULL for readable JSON.  A field of an unexpected shape also marks the
    row as corrupt, so flagged rows, and only those, get a second look."""
    flagged = parsed[CORRUPT]
    unreadable = flagged.isNotNull() & F.try_parse_json(flagged).isNull()
    return F.when(parsed.isNull() | unreadable, F.lit(MALFORMED))


def _measures(entry: Column) -> dict[str, Column]:
    """Measures of a current response or of one forecast entry."""
    main, wind = entry["main"], entry["wind"]
    text = F.get(entry["weather"], F.lit(0))
    return {
        "temperature": main["temp"],
        "feels_like": main["feels_like"],
        "temp_min": main["temp_min"],
        "temp_max": main["temp_max"],
        "humidity": casts.to_whole(main["humidity"]),
        "pressure": casts.to_whole(main["pressure"]),
        "sea_level": casts.to_whole(main["sea_level"]),
        "ground_level": casts.to_whole(main["grnd_level"]),
        "wind_speed": wind["speed"],
        "wind_direction": casts.to_whole(wind["deg"]),
        "wind_gust": wind["gust"],
        "weather_main": text["main"],
        "weather_description": text["description"],
        "cloudiness": casts.to_whole(entry["clouds"]["all"]),
        "visibility": casts.to_whole(entry["visibility"]),
        "api_timestamp": casts.epoch_to_utc(entry["dt"]),
    }


def _current_place(node: Column) -> dict[str, Column]:
    """Own fields first, the ``city`` object second.  An own ``coord`` or
    ``sys`` object hides its fallback even when it is incomplete."""
    city = node["city"]
    return {
        "city": F.coalesce(node["name"], city["name"]),
        "country": F.coalesce(node["sys"]["country"], city["country"]),
        "coord": F.coalesce(node["coord"], city["coord"]),
        "sunrise": F.when(node["sys"].isNotNull(), node["sys"]["sunrise"]).otherwise(city["sunrise"]),
        "sunset": F.when(node["sys"].isNotNull(), node["sys"]["sunset"]).otherwise(city["sunset"]),
    }


def _forecast_place(node: Column) -> dict[str, Column]:
    city = node["city"]
    return {
        "city": city["name"],
        "country": city["country"],
        "coord": city["coord"],
        "sunrise": city["sunrise"],
        "sunset": city["sunset"],
    }


def _record(place: dict[str, Column], entry: Column) -> dict[str, Column]:
    coord = place["coord"]
    pair = coord["lat"].isNotNull() & coord["lon"].isNotNull()
    return {
        "city": place["city"],
        "country": place["country"],
        # Coordinates count only as a pair.
        "latitude": F.when(pair, coord["lat"]),
        "longitude": F.when(pair, coord["lon"]),
        **_measures(entry),
        "sunrise_time": casts.epoch_to_utc(place["sunrise"]),
        "sunset_time": casts.epoch_to_utc(place["sunset"]),
    }


def _current_record(node: Column) -> dict[str, Column]:
    return _record(_current_place(node), node)


def _forecast_record(node: Column) -> dict[str, Column]:
    return _record(_forecast_place(node), F.get(node["list"], F.lit(0)))


def _record_by_kind(node: Column) -> dict[str, Column]:
    """One pass over a mix of kinds: pick place and entry per row, convert once."""
    is_forecast = F.col("kind") == FORECAST
    ahead, now = _forecast_place(node), _current_place(node)
    place = {name: F.when(is_forecast, ahead[name]).otherwise(now[name]) for name in now}
    entry = F.when(is_forecast, F.get(node["list"], F.lit(0))).otherwise(
        F.struct(*(node[name].alias(name) for name in _ENTRY_FIELDS))
    )
    return _record(place, entry)


def _uv_record(node: Column) -> dict[str, Column]:
    url = F.col("request_url")
    return {
        "latitude": url_param(url, "lat").try_cast(COORDINATE_KEY),
        "longitude": url_param(url, "lon").try_cast(COORDINATE_KEY),
        "uv_index": node["value"],
    }


def _parse(landing: DataFrame, body: str, schema: str, record) -> DataFrame:
    """Read the body once into a struct, then project its leaves.

    The struct comes out of a one-element explode.  A filter on what was parsed
    would otherwise be pushed below the projection and parse every body again.
    """
    keep = [F.col(name) for name in landing.columns if name != "city"]
    node = F.col("_body")
    parsed = landing.select("*", F.explode(F.array(_read_body(F.col(body), schema))).alias("_body"))
    return parsed.select(
        *keep,
        *(value.alias(name) for name, value in record(node).items()),
        _malformed(node).alias("parse_error"),
    )


def parse_current(landing: DataFrame, body: str = "body") -> DataFrame:
    """Current-conditions bodies; also those requested by coordinates."""
    return _parse(landing, body, schemas.CURRENT_BODY, _current_record)


def parse_forecast_first(landing: DataFrame, body: str = "body") -> DataFrame:
    """Forecast bodies: the city's attributes and the first entry's measures."""
    return _parse(landing, body, schemas.FORECAST_BODY, _forecast_record)


def parse_records(landing: DataFrame, body: str = "body") -> DataFrame:
    """Forecast and current bodies together, told apart by ``kind``."""
    return _parse(landing, body, schemas.RECORD_BODY, _record_by_kind)


def parse_uv(landing: DataFrame, body: str = "body") -> DataFrame:
    """UV bodies; the coordinates come from the request, not from the body."""
    return _parse(landing, body, schemas.UV_BODY, _uv_record)


def split(parsed: DataFrame) -> DataFrame:
    """Add ``part``: both outcomes from one pass, for a write partitioned by it."""
    kept = F.col("parse_error").isNull()
    return parsed.withColumn("part", F.when(kept, "kept").otherwise("rejected"))


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("parse_error").isNull())


def unreadable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("parse_error").isNotNull())
