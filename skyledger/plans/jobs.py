"""Complete jobs: responses in, stored records and reports out."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.functions.text import redact_param
from skyledger.operators import latest, lookup, moments, parse, quality, stats
from skyledger.operators.enrich import enrich
from skyledger.shared import compiled_projections, written
from skyledger.sinks.table import BatchCounts, ensure_table, write_batch
from skyledger.sources import landing as land
from skyledger.sources.cities import DEFAULT_CITIES
from skyledger.sources.stored import (
    FAILED,
    SEEN,
    read_batch,
    read_cities,
    read_valid,
    stored_latest,
)


class Reports(Mapping):
    """Reports by name, each one planned when it is asked for: a cycle whose reports
    nobody reads lists no folder of the table."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]] | None = None):
        self._builders = builders or {}

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


@dataclass(frozen=True)
class RunResult:
    counts: BatchCounts | None
    reports: Reports = field(default_factory=Reports)


def records_from(responses: DataFrame) -> DataFrame:
    """Typed records of all record-bearing responses, UV joined, failures kept.

    A failed fetch, unreadable body or unknown kind is a row with ``fetch_error``
    or ``parse_error`` set, so one bad response never stops the others and none is
    lost.  Records are read in one pass; UV responses in another, reduced to one row
    per place and cycle and written before the join.
    """
    triaged = land.triage(responses)
    return lookup.uv_enrich(record_rows(triaged), uv_rows(triaged))


def uv_rows(triaged: DataFrame) -> DataFrame:
    """UV readings of the responses that can be read."""
    uv = land.of_kind(triaged, land.UV).filter(F.col("outcome") == "ok")
    return parse.readable(parse.parse_uv(uv))


def record_rows(triaged: DataFrame) -> DataFrame:
    """Records before the UV join.  Only what may be set aside keeps its raw body."""
    ok = F.col("outcome") == "ok"
    fetched = land.record_bearing(triaged).withColumns(
        {
            "requested_city": F.col("city"),
            "request_url": redact_param(F.col("request_url"), "appid"),
            # A body counts only when its fetch did.
            "_usable": F.when(ok, F.col("body")),
        }
    )
    records = (
        parse.parse_records(fetched, "_usable")
        .withColumn("parse_error", F.when(F.col("fetch_error").isNull(), F.col("parse_error")))
        .drop("kind", "status", "outcome", "_usable")
    )
    broken = quality.broken_rules(quality.integrity_rules(records.columns)) != ""
    bad = F.col("fetch_error").isNotNull() | F.col("parse_error").isNotNull() | broken
    return records.withColumn("body", F.when(bad, F.col("body")))


def run_batch(
    responses: DataFrame,
    root: str,
    batch: str | None = None,
    profile: str | None = "strict",
    summary: bool = False,
    cities: str = DEFAULT_CITIES,
    database: Callable[[DataFrame], None] | None = None,
) -> RunResult:
    """Parse, enrich, store, report.

    ``profile=None`` stores without enrichment.  ``summary`` adds the sample and
    the end-of-batch report.  Reports are lazy and read the batch as written,
    so nothing is parsed twice and nothing has to stay cached.  ``database`` gets the
    accepted records of the batch, ids included, to append them elsewhere as well
    (:func:`skyledger.sinks.jdbc.append`, for instance).
    """
    if responses.isEmpty():
        return RunResult(None)
    triaged = land.triage(responses)
    uv = lookup.readings(uv_rows(triaged))
    return store_records(
        record_rows(triaged), uv, root, batch, profile, summary, cities, database
    )


def store_records(
    records: DataFrame,
    uv: DataFrame,
    root: str,
    batch: str | None,
    profile: str | None = "strict",
    summary: bool = False,
    cities: str = DEFAULT_CITIES,
    database: Callable[[DataFrame], None] | None = None,
) -> RunResult:
    """Join records to their UV readings, enrich, store, report."""
    # One writer at a time per table, so one slot of scratch per table is enough.
    lookups = written(uv, "uv", slot=hashlib.md5(root.encode()).hexdigest()[:12])
    return store_joined(
        lookup.join_uv(records, lookups), root, batch, profile, summary, cities, database
    )


def store_joined(
    records: DataFrame,
    root: str,
    batch: str | None,
    profile: str | None = "strict",
    summary: bool = False,
    cities: str = DEFAULT_CITIES,
    database: Callable[[DataFrame], None] | None = None,
    keep_empty: bool = True,
) -> RunResult:
    """Enrich, store, report.  Without ``keep_empty`` no rows are no batch."""
    spark = records.sparkSession
    with compiled_projections(spark):
        if profile is not None:
            records = enrich(records, profile)
        ensure_table(spark, root)
        counts = write_batch(records, root, batch, keep_empty)
        if not (keep_empty or counts.stored or counts.errors):
            return RunResult(None)
        if database is not None:
            database(read_valid(spark, root, counts.batch))
    return RunResult(counts, reports(spark, root, counts.batch, profile, summary, cities))


def processed(spark: SparkSession, root: str, batch: str) -> DataFrame:
    """What a batch's reports look at: every record that was read, whether or not it was
    accepted, with its measures as they were read, before the store narrowed them."""
    rows = read_batch(spark, root, batch).filter(F.col("outcome") != FAILED)
    seen = {
        name: F.coalesce(F.col("seen")[name], F.col(name).cast(SEEN[name].dataType))
        for name in SEEN.fieldNames()
    }
    return rows.withColumns(seen).withColumnRenamed("city", "city_name")


def reports(
    spark: SparkSession, root: str, batch: str, profile: str | None, summary: bool, cities: str
) -> Reports:
    def every() -> DataFrame:
        return read_cities(spark, root)

    def rows() -> DataFrame:
        return processed(spark, root, batch)

    required = ("temperature", "humidity", "city_name")
    found: dict[str, Callable[[], DataFrame]] = {
        "total_count": lambda: moments.total_count(every()),
        "city_coverage": lambda: lookup.city_coverage(spark, every(), cities, F.col("row_count")),
    }
    if profile is None:
        return Reports(found)
    found |= {
        "data_quality": lambda: quality.data_quality(rows(), required),
        "describe": lambda: stats.describe(rows()),
        "temperature_stats": lambda: stats.temperature_stats(rows()),
        "patterns": lambda: stats.patterns(rows()),
        "comfort_distribution": lambda: stats.distribution_with_share(rows()),
    }
    if profile == "zero_default":
        found |= {
            "profile_distributions": lambda: stats.profile_distributions(rows()),
            "extreme_count": lambda: stats.extreme_count(rows()),
            "average_quality": lambda: stats.average_quality(rows()),
        }
    if summary:
        found |= {
            "sample": lambda: latest.sample(rows()),
            "batch_summary": lambda: stats.batch_summary(rows()),
        }
    return Reports(found)


def run_single(responses: DataFrame, root: str, batch: str | None = None, **options) -> RunResult:
    """Enrich, analyse, store."""
    return run_batch(responses, root, batch, **options)


def run_with_summary(responses: DataFrame, root: str, batch: str | None = None, **options) -> RunResult:
    """As :func:`run_single`, with sample and batch summary."""
    return run_batch(responses, root, batch, summary=True, **options)


def run_plain(responses: DataFrame, root: str, batch: str | None = None, **options) -> RunResult:
    """Store what was fetched, without enrichment."""
    return run_batch(responses, root, batch, profile=None, **options)


def round_trip(responses: DataFrame, root: str, city: str = "London") -> DataFrame:
    """Store one city's responses and read its newest record back.  Responses requested by
    coordinates name no city, so all of them are stored: what their bodies say counts."""
    spark = responses.sparkSession
    asked = F.coalesce(F.col("city") == city, F.lit(True))
    run_plain(responses.filter(asked), root)
    return stored_latest(spark, root, city, 1)


__all__ = [
    "RunResult",
    "processed",
    "records_from",
    "round_trip",
    "run_batch",
    "run_plain",
    "run_single",
    "run_with_summary",
]
