"""Analytics per fetch cycle as a stream: one aggregation with state, closed by a watermark.

Records are reduced to cells of a cycle (its name and a window of its time): rows and
moments per city, description and labels.  A cell leaves the state once, when no record of
its window may come any more; every report of a cycle adds up cells.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators import moments, stats
from skyledger.operators.enrich import enrich
from skyledger.plans.jobs import record_rows
from skyledger.schemas import LANDING
from skyledger.sources import landing as land
from skyledger.streaming.cycle import DEFAULT_INTERVAL, LATENESS, end_stream, ends, state_parts

_AT = "_at"
_LABELS = ("weather_description", "temperature_category", "comfort_level")
_MEASURES = ("temperature",)


def cells(responses: DataFrame, marks: DataFrame, every: str, lateness: timedelta, profile: str) -> DataFrame:
    """Cells of closed windows.  A record without a fetch time counts when it is seen."""
    records = record_rows(land.triage(responses)).filter("fetch_error IS NULL AND parse_error IS NULL")
    # A wall clock in UTC as an instant, whatever the session's zone.
    micros = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', fetched_at)"
    at = F.coalesce(F.timestamp_micros(F.expr(micros)), F.current_timestamp())
    used = enrich(records, profile).select(
        at.alias(_AT), F.coalesce("cycle", F.lit("")).alias("cycle"), "city", *_LABELS, *_MEASURES
    )
    nowhere = [F.lit(None).cast(f.dataType).alias(f.name) for f in used.schema if f.name != _AT]
    used = used.unionByName(marks.select(F.to_timestamp("at").alias(_AT), *nowhere))
    timed = used.withWatermark(_AT, f"{int(lateness.total_seconds())} seconds")
    timed = timed.withColumn("_window", F.window(_AT, every))
    return moments.of(timed, "_window", "cycle", "city", *_LABELS, measures=_MEASURES).drop("_window")


def start_reports(
    responses: DataFrame,
    path: str,
    checkpoint: str,
    stream: str = "reports",
    interval: int | None = DEFAULT_INTERVAL,
    every: str = "1 hour",
    lateness: timedelta = LATENESS,
    profile: str = "strict",
) -> StreamingQuery:
    """Append the cells of every cycle to ``path`` once its windows of ``every`` are past by
    ``lateness``.  A record that comes later than that is stored by the cycles all the same
    (:mod:`skyledger.streaming.cycle`), but its report is closed.  Each cell is written
    once, also over restarts."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": f"{interval} seconds"}
    marks = ends(responses.sparkSession, checkpoint)
    with state_parts(responses.sparkSession):
        return (
            cells(responses.select(*LANDING.fieldNames()), marks, every, lateness, profile)
            .writeStream.queryName(stream)
            .format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )


def close_reports(responses: DataFrame, path: str, checkpoint: str, **options) -> None:
    """End the stream: write the cells that are still open."""
    end_stream(responses.sparkSession, checkpoint)
    start_reports(responses, path, checkpoint, interval=None, **options).awaitTermination()


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Cells of closed cycles."""
    return spark.read.parquet(path)


def cycle_temperature_stats(spark: SparkSession, path: str) -> DataFrame:
    """Mean, extremes and deviation of temperature per cycle and city."""
    merged = moments.merged(read_cells(spark, path), "cycle", "city", measures=_MEASURES)
    return merged.select("cycle", "city", *moments.temperature_columns())


def cycle_patterns(spark: SparkSession, path: str) -> DataFrame:
    """Rows per cycle, description and temperature category, most frequent first."""
    keys = ("cycle", "weather_description", "temperature_category")
    counted = read_cells(spark, path).groupBy(*keys).agg(F.sum("row_count").alias("row_count"))
    return counted.orderBy("cycle", F.desc("row_count"), *keys[1:])


def cycle_comfort(spark: SparkSession, path: str) -> DataFrame:
    """Rows per cycle and comfort level, with the share of the cycle's rows."""
    counted = read_cells(spark, path).groupBy("cycle", "comfort_level").agg(F.sum("row_count").alias("row_count"))
    whole = F.sum("row_count").over(Window.partitionBy("cycle"))
    return counted.withColumn("percentage", stats.share(F.col("row_count"), whole))
