"""Sums that add up: counts and moments of measures per key, merged exactly.

For each measure its values' number, sum, sum of squares, minimum and maximum are kept as
exact decimals.  Those of parts are added up to those of the whole, whatever the parts and
their order, so the mean and deviation of many batches are those of one pass over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.operators.stats import PLACES

MEASURES = ("temperature", "humidity", "pressure", "wind_speed")
# Stored measures have at most ten digits before the point and two after it.
_VALUE, _SUM, _SQUARES = "decimal(12,2)", "decimal(30,2)", "decimal(38,4)"
_PARTS = {"n": "bigint", "sum": _SUM, "squares": _SQUARES, "min": _VALUE, "max": _VALUE}


def schema(key: str, measures: Sequence[str] = MEASURES) -> str:
    cells = (f"{name}_{part} {kind}" for name in measures for part, kind in _PARTS.items())
    return ", ".join([key, "row_count bigint", *cells])


def of(records: DataFrame, *keys: str, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Rows and moments per key, in the columns of :func:`schema`."""
    cells = []
    for name in measures:
        value = F.col(name).cast(_VALUE)
        cells += [
            F.count(name).alias(f"{name}_n"),
            F.sum(value).cast(_SUM).alias(f"{name}_sum"),
            F.sum(value * value).cast(_SQUARES).alias(f"{name}_squares"),
            F.min(value).alias(f"{name}_min"),
            F.max(value).alias(f"{name}_max"),
        ]
    return records.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), *cells)


def merged(parts: DataFrame, *keys: str, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Moments of parts added up per key; without keys, one row for all."""
    add = {"n": F.sum, "sum": F.sum, "squares": F.sum, "min": F.min, "max": F.max}
    cells = [
        add[part](f"{name}_{part}").cast(kind).alias(f"{name}_{part}")
        for name in measures
        for part, kind in _PARTS.items()
    ]
    return parts.groupBy(*keys).agg(F.sum("row_count").alias("row_count"), *cells)


def mean(name: str) -> Column:
    n, total = F.col(f"{name}_n"), F.col(f"{name}_sum")
    return F.round(F.try_divide(total.cast("double"), n), PLACES)


def deviation(name: str) -> Column:
    """Sample standard deviation from exact sums; NULL for fewer than two values."""
    n, total, squares = (F.col(f"{name}_{part}") for part in ("n", "sum", "squares"))
    # n * squares - sum * sum, without a rounding before the difference.
    spread = n.cast("decimal(18,0)") * squares - total * total
    pairs = n.cast("double") * (n - 1).cast("double")
    return F.when(n > 1, F.round(F.sqrt(spread.cast("double") / pairs), PLACES))


def temperature_columns() -> list[Column]:
    """What :func:`skyledger.operators.stats.temperature_stats` tells, from merged parts."""
    return [
        mean("temperature").alias("avg_temperature"),
        F.col("temperature_min").cast("double").alias("min_temperature"),
        F.col("temperature_max").cast("double").alias("max_temperature"),
        deviation("temperature").alias("temp_stddev"),
    ]


def temperature_stats(parts: DataFrame, by: str = "city") -> DataFrame:
    return merged(parts, by, measures=("temperature",)).select(by, *temperature_columns())


def describe(parts: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """The columns of :func:`skyledger.operators.stats.describe`, from parts."""
    cells = [
        F.struct(
            F.lit(name).alias("measure"),
            F.coalesce(F.col(f"{name}_n"), F.lit(0)).alias("n"),
            mean(name).alias("mean"),
            deviation(name).alias("stddev"),
            F.col(f"{name}_min").cast("double").alias("min"),
            F.col(f"{name}_max").cast("double").alias("max"),
        )
        for name in measures
    ]
    return merged(parts, measures=measures).select(F.inline(F.array(*cells)))


def total_count(parts: DataFrame) -> DataFrame:
    return parts.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_records"))


def count_by_city(parts: DataFrame, city: str) -> DataFrame:
    rows = parts.filter(F.col("city") == city)
    return rows.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("city_records"))
