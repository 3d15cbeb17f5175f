"""Bodies of any shape: one parse into a VARIANT, leaves taken from it, the rest kept.

The readers of :mod:`skyledger.operators.parse` know the fields they want and read no others.
Here a body is parsed as it is, whatever its kind: one pass over a mix of records and UV
readings, and fields nobody asked for stay in ``document`` for later.  The leaves are the
same, but for a body that repeats a key in an object, which VARIANT does not take: it is
malformed here, and there its last value counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.functions import casts
from skyledger.functions.text import url_param
from skyledger.operators.parse import COORDINATE_KEY, MALFORMED
from skyledger.schemas import WIDE
from skyledger.sources.landing import FORECAST, UV

_NUMBER = WIDE.simpleString()
_SUN = f"sunrise:{_NUMBER},sunset:{_NUMBER}"
_COORD = f"struct<lat:{_NUMBER},lon:{_NUMBER}>"
_PLACE = (
    f"struct<name:string,sys:struct<country:string,{_SUN}>,coord:{_COORD},"
    f"city:struct<name:string,country:string,coord:{_COORD},{_SUN}>>"
)
_MAIN = ",".join(
    f"{name}:{_NUMBER}"
    for name in ("temp", "feels_like", "temp_min", "temp_max", "humidity", "pressure", "sea_level", "grnd_level")
)
_ENTRY = (
    f"struct<main:struct<{_MAIN}>,wind:struct<speed:{_NUMBER},deg:{_NUMBER},gust:{_NUMBER}>,"
    f"clouds:struct<`all`:{_NUMBER}>,visibility:{_NUMBER},dt:{_NUMBER}>"
)
_WORDS = "struct<main:string,description:string>"


def _read(document: Column) -> Column:
    """What is taken from a document: each object is walked once, its leaves are cast as
    they are met.  A leaf that does not fit is NULL and spoils no sibling."""
    ahead, is_uv = F.col("kind") == FORECAST, F.col("kind") == UV

    def first(path: str, kind: str) -> Column:
        """Of a forecast's first entry, or of the body itself; of a UV body nothing."""
        own = F.when(~is_uv, F.try_variant_get(document, f"${path}", kind))
        return F.when(ahead, F.try_variant_get(document, f"$.list[0]{path}", kind)).otherwise(own)

    return F.struct(
        document.alias("document"),
        F.when(~is_uv, F.try_variant_get(document, "$", _PLACE)).alias("place"),
        first("", _ENTRY).alias("entry"),
        first(".weather[0]", _WORDS).alias("words"),
        F.when(is_uv, F.try_variant_get(document, "$.value", _NUMBER)).alias("value"),
    )


def _measures(entry: Column, words: Column) -> dict[str, Column]:
    main, wind = entry["main"], entry["wind"]
    return {
        "temperature": main["temp"],
        "feels_like": main["feels_like"],
        "temp_min": main["temp_min"],
        "temp_max": main["temp_max"],
        "wind_speed": wind["speed"],
        "wind_gust": wind["gust"],
        "humidity": casts.to_whole(main["humidity"]),
        "pressure": casts.to_whole(main["pressure"]),
        "sea_level": casts.to_whole(main["sea_level"]),
        "ground_level": casts.to_whole(main["grnd_level"]),
        "wind_direction": casts.to_whole(wind["deg"]),
        "cloudiness": casts.to_whole(entry["clouds"]["all"]),
        "visibility": casts.to_whole(entry["visibility"]),
        "weather_main": words["main"],
        "weather_description": words["description"],
        "api_timestamp": casts.epoch_to_utc(entry["dt"]),
    }


def _record(place: Column, entry: Column, words: Column) -> dict[str, Column]:
    """Forecasts have their place below ``city`` and measures in the first entry; current
    bodies their own, then ``city``.  An own ``coord`` or ``sys`` object hides its fallback."""
    ahead = F.col("kind") == FORECAST
    city = place["city"]

    def own(mine: Column, name: str, below: Column) -> Column:
        return F.when(~ahead & mine.isNotNull(), mine[name]).otherwise(below[name])

    latitude, longitude = (own(place["coord"], name, city["coord"]) for name in ("lat", "lon"))
    pair = latitude.isNotNull() & longitude.isNotNull()
    return {
        "city": F.coalesce(F.when(~ahead, place["name"]), city["name"]),
        "country": F.coalesce(F.when(~ahead, place["sys"]["country"]), city["country"]),
        "latitude": F.when(pair, latitude),
        "longitude": F.when(pair, longitude),
        **_measures(entry, words),
        "sunrise_time": casts.epoch_to_utc(own(place["sys"], "sunrise", city)),
        "sunset_time": casts.epoch_to_utc(own(place["sys"], "sunset", city)),
    }


def parse_documents(landing: DataFrame, body: str = "body") -> DataFrame:
    """Bodies of every kind in one pass: a record's columns, ``uv_index``, ``parse_error`` and
    the whole ``document``.  Of UV bodies only the value and the place of their request are
    read; the landing's ``city`` gives way to the body's."""
    keep = [F.col(name) for name in landing.columns if name != "city"]
    # A one-element generator: a filter on a leaf does not parse the body again.
    whole = F.array(F.try_parse_json(F.col(body)))
    parsed = landing.select("*", F.inline(F.transform(whole, _read)))
    place = F.col("place")
    is_uv = F.col("kind") == UV
    url = F.col("request_url")
    asked = {"latitude": "lat", "longitude": "lon"}
    columns = {}
    for name, value in _record(place, F.col("entry"), F.col("words")).items():
        other = F.when(~is_uv, value)
        if name in asked:
            other = F.coalesce(F.when(is_uv, url_param(url, asked[name]).try_cast(COORDINATE_KEY)), other)
        columns[name] = other
    columns["uv_index"] = F.col("value")
    columns["parse_error"] = F.when(F.col("document").isNull(), F.lit(MALFORMED))
    return parsed.select(*keep, "document", *(value.alias(name) for name, value in columns.items()))
