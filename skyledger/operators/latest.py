"""Bounded, ordered reads of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

# The columns a report shows of a sample.
SAMPLE_COLUMNS = (
    "city_name",
    "temperature",
    "temperature_category",
    "heat_index",
    "comfort_level",
    "wind_category",
    "data_quality_score",
)


def latest(records: DataFrame, n: int = 10, at: str = "recorded_at", tie: str = "id") -> DataFrame:
    """Newest ``n`` rows.  Each task keeps ``n``; nothing is sorted as a whole."""
    return records.orderBy(F.col(at).desc_nulls_first(), F.col(tie).desc()).limit(n)


def latest_by_city(
    records: DataFrame,
    city: str,
    n: int,
    at: str = "recorded_at",
    tie: str = "id",
    column: str = "city",
) -> DataFrame:
    return latest(records.filter(F.col(column) == city), n, at, tie)


def latest_per_key(
    records: DataFrame, key: str, n: int, at: str = "recorded_at", tie: str = "id"
) -> DataFrame:
    """Newest ``n`` rows of every key.  The filter on the rank becomes a limit within each
    task before the shuffle, up to the optimizer's threshold for it (1000)."""
    newest = Window.partitionBy(key).orderBy(F.col(at).desc_nulls_first(), F.col(tie).desc())
    ranked = records.withColumn("_place", F.row_number().over(newest))
    return ranked.filter(F.col("_place") <= n).drop("_place")


def sample(
    records: DataFrame,
    n: int = 20,
    key: str = "id",
    columns: Sequence[str] = SAMPLE_COLUMNS,
) -> DataFrame:
    """First ``n`` rows by key, a few columns: what a person looks at."""
    return records.orderBy(key).limit(n).select(key, *columns)
