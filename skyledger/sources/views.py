"""Records under a view name, for users who write SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

RAW_VIEW = "weather_raw"


def camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(part.capitalize() for part in rest)


def register(records: DataFrame, name: str = RAW_VIEW) -> DataFrame:
    """Session view of the records with camel-case columns (``feelsLike``)."""
    view = records.select(*(F.col(c).alias(camel(c)) for c in records.columns))
    view.createOrReplaceTempView(name)
    return view
