"""The two enrichment profiles, as DataFrame transformations.

Both add their columns in one projection; every source column stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.functions import casts, rules

# The 20-column report projection (source column, report column), and below
# it the columns that the second profile stores.
REPORT_SOURCES = (
    ("city", "city_name"),
    ("country", "country"),
    ("temperature", "temperature"),
    ("feels_like", "feels_like"),
    ("humidity", "humidity"),
    ("pressure", "pressure"),
    ("weather_description", "weather_description"),
    ("wind_speed", "wind_speed"),
    ("wind_direction", "wind_direction"),
    ("visibility", "visibility"),
    ("uv_index", "uv_index"),
    ("api_timestamp", "timestamp"),
)
REPORT_DERIVED = (
    "temperature_category",
    "heat_index",
    "wind_category",
    "comfort_level",
    "data_quality_score",
    "processing_timestamp",
    "temperature_celsius",
    "temperature_fahrenheit",
)

# What a record keeps when the zero-default profile is stored.
STORAGE_COLUMNS = (
    "city",
    "country",
    "temperature",
    "feels_like",
    "humidity",
    "pressure",
    "wind_speed",
    "wind_direction",
    "weather_description",
    "visibility",
    "api_timestamp",
)


def strict_columns() -> dict[str, Column]:
    t, h, w = F.col("temperature"), F.col("humidity"), F.col("wind_speed")
    return {
        "temperature_category": rules.temperature_category(t),
        "heat_index": rules.heat_index(t, h),
        "wind_category": rules.wind_category(w),
        "comfort_level": rules.comfort_level(t, h),
        "data_quality_score": rules.quality_binary(t, h, F.col("pressure")),
        "processing_timestamp": casts.utc_now(),
        "temperature_celsius": t,
        "temperature_fahrenheit": rules.fahrenheit(t),
    }


def zero_default_columns() -> dict[str, Column]:
    raw_t, raw_h, raw_w = F.col("temperature"), F.col("humidity"), F.col("wind_speed")
    t, h, w = (rules.zero_default(c) for c in (raw_t, raw_h, raw_w))
    text = F.col("weather_description")
    return {
        "temperature_fahrenheit": rules.fahrenheit(t),
        "temperature_category": rules.temperature_category(t),
        "heat_index": rules.heat_index(t, h),
        "wind_category": rules.wind_category(w),
        "comfort_level": rules.comfort_level(t, h),
        # Scores look at what was really reported, not at the defaults.
        "data_quality_score": rules.quality_weighted(raw_t, raw_h, F.col("pressure"), raw_w, text),
        "weather_severity_index": rules.severity(raw_t, raw_w, text),
        "is_extreme": rules.extreme(t, w, h),
        "recommendation": rules.recommendation(t, h, w, text),
    }


PROFILES = {"strict": strict_columns, "zero_default": zero_default_columns}


def enrich(records: DataFrame, profile: str = "strict") -> DataFrame:
    return records.withColumns(PROFILES[profile]())


def report_projection(enriched: DataFrame) -> DataFrame:
    """The strict profile as the 20-column report table."""
    return enriched.select(
        *(F.col(source).alias(name) for source, name in REPORT_SOURCES), *REPORT_DERIVED
    )


def storage_projection(records: DataFrame) -> DataFrame:
    """Source columns only; everything derived is left out."""
    return records.select(*STORAGE_COLUMNS)
