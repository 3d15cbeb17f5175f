"""Reports over enriched records.

Every report is one partial-then-final aggregation, so a city or category that
holds most rows is reduced inside each task before anything is shuffled.
Sums run over decimals, so a result does not depend on row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

PLACES = 6
# A sum of the stored types would end at 1e13; this one at 1e20.
SUM = "decimal(38,18)"


def row_count() -> Column:
    return F.count(F.lit(1)).alias("row_count")


def exact_mean(value: Column) -> Column:
    """Mean from the exact sum; NULL when there is no value."""
    return F.round(F.try_divide(F.sum(value.cast(SUM)).cast("double"), F.count(value)), PLACES)


def sample_deviation(value: Column) -> Column:
    """Sample standard deviation; NULL for fewer than two values."""
    return F.round(F.stddev_samp(value.cast("double")), PLACES)


def temperature_stats(records: DataFrame, by: str = "city_name") -> DataFrame:
    t = F.col("temperature")
    return records.groupBy(by).agg(
        exact_mean(t).alias("avg_temperature"),
        F.min(t).cast("double").alias("min_temperature"),
        F.max(t).cast("double").alias("max_temperature"),
        sample_deviation(t).alias("temp_stddev"),
    )


def patterns(
    records: DataFrame, by: Sequence[str] = ("weather_description", "temperature_category")
) -> DataFrame:
    """Rows per combination, most frequent first; the keys break ties."""
    return records.groupBy(*by).agg(row_count()).orderBy(F.desc("row_count"), *by)


def share(part: Column, whole: Column) -> Column:
    """Percentage to two places."""
    return F.round(part * F.lit(100.0) / whole, 2)


def distribution(records: DataFrame, by: str) -> DataFrame:
    return records.groupBy(by).agg(row_count()).orderBy(by)


def distribution_with_share(records: DataFrame, by: str = "comfort_level") -> DataFrame:
    """Rows per label with the percentage of all rows.  The window spans the
    grouped result: one row per label, never the records."""
    whole = F.sum("row_count").over(Window.partitionBy())
    return records.groupBy(by).agg(row_count()).withColumn("percentage", share(F.col("row_count"), whole))


def distribution_of_total(records: DataFrame, by: str = "comfort_level") -> DataFrame:
    """The same, with the total as a scalar subquery over the grouped rows."""
    grouped = records.groupBy(by).agg(row_count())
    total = grouped.agg(F.sum("row_count")).scalar()
    return grouped.withColumn("percentage", share(F.col("row_count"), total))


def quality_metrics(records: DataFrame, score: str = "data_quality_score") -> DataFrame:
    return records.agg(
        exact_mean(F.col(score)).alias("avg_quality_score"),
        F.min(score).alias("min_quality_score"),
        F.max(score).alias("max_quality_score"),
    )


def average_quality(records: DataFrame, score: str = "data_quality_score") -> DataFrame:
    """Mean score, zero when there is no record."""
    return records.agg(F.coalesce(exact_mean(F.col(score)), F.lit(0.0)).alias("avg_quality"))


def describe(
    records: DataFrame, columns: Sequence[str] = ("temperature", "humidity", "pressure", "wind_speed")
) -> DataFrame:
    """Count, mean, deviation, minimum and maximum: one row per column, one pass."""
    cells = [
        F.struct(
            F.lit(name).alias("measure"),
            F.count(name).alias("n"),
            exact_mean(F.col(name)).alias("mean"),
            sample_deviation(F.col(name)).alias("stddev"),
            F.min(name).cast("double").alias("min"),
            F.max(name).cast("double").alias("max"),
        )
        for name in columns
    ]
    return records.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def total_count(records: DataFrame) -> DataFrame:
    return records.agg(F.count(F.lit(1)).alias("total_records"))


def count_by_city(records: DataFrame, city: str, column: str = "city") -> DataFrame:
    return records.filter(F.col(column) == city).agg(F.count(F.lit(1)).alias("city_records"))


def extreme_count(records: DataFrame, flag: str = "is_extreme") -> DataFrame:
    return records.agg(
        F.count_if(F.col(flag)).alias("extreme_records"), F.count(F.lit(1)).alias("total_records")
    )


def profile_distributions(
    records: DataFrame,
    by: Sequence[str] = ("temperature_category", "comfort_level", "wind_category"),
) -> DataFrame:
    """Several distributions from one scan, as (dimension, label, row_count).

    Records are reduced to one row per label combination first; only those few
    rows are repeated per dimension.
    """
    cells = records.groupBy(*by).agg(row_count())
    labels = F.array(
        *(F.struct(F.lit(name).alias("dimension"), F.col(name).alias("label")) for name in by)
    )
    return (
        cells.select("row_count", F.inline(labels))
        .groupBy("dimension", "label")
        .agg(F.sum("row_count").alias("row_count"))
    )


def growth(records: DataFrame, city: str = "city", at: str = "recorded_at") -> DataFrame:
    """Rows, cities and time span of a table.

    Reduced to one row per city first: a city that holds a third of the table
    leaves each task as one row, and no task sees the distinct set of rows.
    """
    per_city = records.groupBy(city).agg(
        F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.max(at).alias("last")
    )
    return per_city.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count(city).alias("cities"),
        F.min("first").alias("first_record"),
        F.max("last").alias("latest_record"),
    )


def batch_summary(records: DataFrame) -> DataFrame:
    """The whole end-of-batch report from one scan.

    Rows (section, label, row_count, percentage, value): the three category
    distributions, the total, and the quality score's mean, minimum and maximum.
    """
    keys = ("temperature_category", "comfort_level", "wind_category", "data_quality_score")
    cells = records.groupBy(*keys).agg(row_count())
    score = F.col("data_quality_score")
    no_value = F.lit(None).cast("double")

    def entry(section: str, label: Column, value: Column = no_value) -> Column:
        return F.struct(
            F.lit(section).alias("section"), label.alias("label"), value.alias("value")
        )

    entries = F.array(
        entry("temperature_category", F.col("temperature_category")),
        entry("comfort_level", F.col("comfort_level")),
        entry("wind_category", F.col("wind_category")),
        entry("quality_score", F.lit("all"), score.cast("double")),
    )
    tall = cells.select("row_count", F.inline(entries))
    n, value = F.col("row_count"), F.col("value")
    total = F.sum(F.when(F.col("section") == "quality_score", F.col("row_count")))
    grouped = tall.groupBy("section", "label").agg(
        F.sum(n).alias("row_count"),
        F.round(F.try_divide(F.sum(n * value), F.sum(n)), PLACES).alias("mean_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )
    # A few dozen labels at most, so one task may hold them.
    return grouped.withColumn(
        "percentage", share(F.col("row_count"), total.over(Window.partitionBy()))
    )
