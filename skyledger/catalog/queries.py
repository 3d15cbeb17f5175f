"""Registered queries: each takes (spark, table folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyledger.catalog.observations import (
    observations,
    responses,
    spread_observations,
    table,
)
from skyledger.functions import casts, text
from skyledger.operators import enrich as profiles, latest, lookup, moments, parse, quality, stats, variant
from skyledger.operators.enrich import enrich
from skyledger.plans import jobs
from skyledger.shared import prefer_compiled, scratch_table
from skyledger.schemas import RECORD
from skyledger.sinks import table as sink
from skyledger.sinks.conform import conform
from skyledger.sources import landing, stored, views
from skyledger.sources.cities import DEPLOYED_CITIES, explode_list
from skyledger.streaming import reports
from skyledger.streaming.cycle import dead_letters, flush, start_cycles

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines hand back the same type."""
    return rows.select(
        *(
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in rows.schema.fields
        )
    )


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prefer_compiled(spark)
        return plain(build(spark, sf_dir))

    REGISTRY[build.__name__] = run
    return build


def strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(observations(spark, sf_dir), "strict").withColumnRenamed("city", "city_name")


def zero_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(observations(spark, sf_dir), "zero_default")


PARSED = (
    "obs_id", "city", "country", "latitude", "longitude", "temperature", "feels_like",
    "temp_min", "temp_max", "humidity", "pressure", "sea_level", "ground_level", "wind_speed",
    "wind_direction", "wind_gust", "weather_main", "weather_description", "cloudiness",
    "visibility", "sunrise_time", "sunset_time", "api_timestamp", "parse_error",
)

# Stored columns whose value does not depend on when the job ran.
REPEATABLE = [
    name
    for name in RECORD.fieldNames()
    if name not in ("id", "created_at", "updated_at", "processing_timestamp")
]


# --- sources ----------------------------------------------------------------


@query
def parse_current(spark, sf_dir):
    raw = responses(spread_observations(spark, sf_dir), landing.CURRENT)
    return parse.parse_current(raw).select(*PARSED)


@query
def parse_forecast_first(spark, sf_dir):
    raw = responses(spread_observations(spark, sf_dir), landing.FORECAST)
    return parse.parse_forecast_first(raw).select(*PARSED)


@query
def parse_uv(spark, sf_dir):
    raw = responses(spread_observations(spark, sf_dir), landing.UV)
    return conform_uv(parse.parse_uv(raw)).select(
        "obs_id", "latitude", "longitude", "uv_index", "parse_error"
    )


def conform_uv(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("uv_index", F.col("uv_index").try_cast(RECORD["uv_index"].dataType))


@query
def payload_kinds(spark, sf_dir):
    """Every observation in all four kinds through one landing table, records read in one
    pass."""
    obs = spread_observations(spark, sf_dir)
    raw = responses(obs, landing.UV)
    for kind in landing.RECORD_KINDS:
        raw = raw.unionByName(responses(obs, kind))
    records = parse.parse_records(landing.of_kind(raw, *landing.RECORD_KINDS))
    uv = parse.parse_uv(landing.of_kind(raw, landing.UV))
    measured = records.select("kind", "parse_error", F.col("temperature").alias("value")).unionByName(
        uv.select("kind", "parse_error", F.col("uv_index").alias("value"))
    )
    return measured.groupBy("kind").agg(
        stats.row_count(),
        F.count("parse_error").alias("unreadable"),
        F.count("value").alias("measured"),
        stats.exact_mean(F.col("value")).alias("mean_value"),
    )


@query
def parse_variant(spark, sf_dir):
    """Every observation in all four kinds, each body parsed once, as a document."""
    obs = spread_observations(spark, sf_dir)
    raw = responses(obs, landing.UV)
    for kind in landing.RECORD_KINDS:
        raw = raw.unionByName(responses(obs, kind))
    return conform_uv(variant.parse_documents(raw)).select("kind", *PARSED, "uv_index")


@query
def city_dimension(spark, sf_dir):
    """Rows per entry of the comma-separated lists built from each observation."""
    lists = observations(spark, sf_dir).select(
        F.concat(F.lit(" "), "city", F.lit(" , "), "country", F.lit(","), "weather_main", F.lit(" ,,")).alias(
            "cities"
        )
    )
    return explode_list(lists, "cities", "city").groupBy("city").agg(stats.row_count())


@query
def landing_files(spark, sf_dir):
    """Responses through JSON files in the landing layout."""
    obs = spread_observations(spark, sf_dir)
    path = scratch_table(spark, "landing")
    for kind in (landing.FORECAST, landing.UV):
        landing.write_landing(responses(obs, kind), path)
    rows = landing.triage(landing.read_landing(spark, path))
    return rows.groupBy("kind", "outcome").agg(
        stats.row_count(),
        F.count("city").alias("with_city"),
        F.max("fetched_at").alias("last_fetch"),
        F.count("body").alias("with_body"),
    )


@query
def raw_view(spark, sf_dir):
    """The enrichment as SQL text over the registered view."""
    views.register(observations(spark, sf_dir))
    return spark.sql(
        """SELECT obsId AS obs_id, city AS city_name, country, temperature,
             feelsLike AS feels_like, humidity, pressure,
             weatherDescription AS weather_description, windSpeed AS wind_speed,
             windDirection AS wind_direction, visibility, apiTimestamp AS `timestamp`,
             CASE WHEN temperature < 0 THEN 'Freezing' WHEN temperature <= 10 THEN 'Cold'
               WHEN temperature <= 20 THEN 'Mild' WHEN temperature <= 30 THEN 'Warm'
               ELSE 'Hot' END AS temperature_category,
             CASE WHEN windSpeed < 5 THEN 'Light' WHEN windSpeed <= 15 THEN 'Moderate'
               WHEN windSpeed <= 25 THEN 'Strong' ELSE 'Very Strong' END AS wind_category,
             CASE WHEN temperature BETWEEN 18 AND 24 AND humidity BETWEEN 40 AND 60
                 THEN 'Comfortable'
               WHEN temperature < 5 OR temperature > 35 THEN 'Uncomfortable'
               WHEN humidity > 80 OR humidity < 20 THEN 'Humid/Dry'
               ELSE 'Moderate' END AS comfort_level
           FROM weather_raw"""
    )


@query
def response_triage(spark, sf_dir):
    raw = responses(spread_observations(spark, sf_dir), landing.FORECAST)
    return landing.triage(raw).select("obs_id", "outcome", "fetch_error")


@query
def parse_reject_split(spark, sf_dir):
    raw = responses(spread_observations(spark, sf_dir), landing.FORECAST)
    return parse.split(parse.parse_forecast_first(raw)).select("obs_id", "part")


# --- sinks ------------------------------------------------------------------


@query
def sink_valid_split(spark, sf_dir):
    checked = quality.check(observations(spark, sf_dir))
    return checked.select("obs_id", "is_valid", F.array_join("reasons", ",").alias("reasons"))


@query
def sink_conform(spark, sf_dir):
    obs = observations(spark, sf_dir)
    names = [name for name in RECORD.fieldNames() if name in obs.columns]
    return conform(obs).select(*names)


@query
def storage_projection(spark, sf_dir):
    return profiles.storage_projection(zero_default(spark, sf_dir))


@query
def conform_missing_columns(spark, sf_dir):
    few = observations(spark, sf_dir).select("humidity", "city", "temperature")
    return conform(few).select(
        "city", "country", "latitude", "temperature", "humidity", "pressure", "sunrise_time"
    )


@query
def sample_projection(spark, sf_dir):
    return latest.sample(strict(spark, sf_dir), 20, key="obs_id")


@query
def sink_roundtrip(spark, sf_dir):
    """Write a batch, read the accepted rows back."""
    root = scratch_table(spark, "roundtrip")
    sink.write_batch(with_record_time(enrich(spread_observations(spark, sf_dir))), root, "only")
    return stored.read_valid(spark, root).select(*REPEATABLE)


def with_record_time(obs: DataFrame) -> DataFrame:
    return obs.withColumn("recorded_at", F.col("api_timestamp"))


@query
def sink_quarantine(spark, sf_dir):
    root = scratch_table(spark, "quarantine")
    sink.write_batch(spread_observations(spark, sf_dir), root, "only")
    kept = F.get_json_object("raw_record", "$.obs_id").cast("bigint")
    return stored.read_quarantine(spark, root).select(
        kept.alias("obs_id"), "outcome", F.array_join("reasons", ",").alias("reasons")
    )


@query
def surrogate_keys(spark, sf_dir):
    """Two batches, then the first again: ids never repeat, the second batch starts after
    the first, and the replay stays in the first one's range."""
    root = scratch_table(spark, "keys")
    for name in ("a", "b", "a"):
        sink.write_batch(spread_observations(spark, sf_dir), root, name)
    rows = stored.read_all(spark, root).filter(F.col("outcome") == stored.VALID)
    spans = rows.groupBy("batch").agg(
        stats.row_count(), F.countDistinct("id").alias("ids"), F.min("id").alias("lo"), F.max("id").alias("hi")
    )
    last_of_a = F.max(F.when(F.col("batch") == "a", F.col("hi")))
    first_of_b = F.min(F.when(F.col("batch") == "b", F.col("lo")))
    return spans.agg(
        F.sum("row_count").alias("row_count"),
        F.sum("ids").alias("distinct_ids"),
        (last_of_a < first_of_b).alias("batches_in_order"),
    )


@query
def dense_ids(spark, sf_dir):
    """Three batches, the first one again: ids without a gap, however tasks are cut."""
    rows = stored.read_all(spark, stored_in_parts(spark, sf_dir)).filter(F.col("outcome") == stored.VALID)
    return rows.agg(stats.row_count(), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def stored_in_parts(spark: SparkSession, sf_dir: str, parts: int = 3) -> str:
    """A table of several batches that share the observations; the first is written twice."""
    root = scratch_table(spark, "parts")
    obs = with_record_time(spread_observations(spark, sf_dir))
    for k in [*range(parts), 0]:
        sink.write_batch(obs.filter(F.col("obs_id") % parts == k), root, f"part{k}")
    return root


@query
def summary_total(spark, sf_dir):
    """Rows of the table, from what its batches told the ledger."""
    return moments.total_count(stored.read_cities(spark, stored_in_parts(spark, sf_dir)))


@query
def summary_city_coverage(spark, sf_dir):
    parts = stored.read_cities(spark, stored_in_parts(spark, sf_dir))
    return lookup.city_coverage(spark, parts, DEPLOYED_CITIES + ", Oslo ", F.col("row_count"))


@query
def summary_count_by_city(spark, sf_dir):
    return moments.count_by_city(stored.read_cities(spark, stored_in_parts(spark, sf_dir)), "Tokyo")


@query
def stored_temp_stats(spark, sf_dir):
    """Temperature per city over all batches, from their moments."""
    return moments.temperature_stats(stored.read_cities(spark, stored_in_parts(spark, sf_dir)))


@query
def stored_describe(spark, sf_dir):
    return moments.describe(stored.read_cities(spark, stored_in_parts(spark, sf_dir)))


@query
def stored_latest_per_city(spark, sf_dir):
    """The newest records of every city at once."""
    found = stored.stored_latest_per_city(spark, stored_by_day(spark, sf_dir), 3)
    return found.select("city", "temperature", "weather_description", "recorded_at")


def stored_by_day(spark: SparkSession, sf_dir: str) -> str:
    """A table of two batches, half of the observations each."""
    root = scratch_table(spark, "days")
    obs = with_record_time(enrich(spread_observations(spark, sf_dir)))
    for name, rest in (("even", 0), ("odd", 1)):
        sink.write_batch(obs.filter(F.col("obs_id") % 2 == rest), root, name)
    return root


@query
def stored_latest_by_city(spark, sf_dir):
    root = stored_by_day(spark, sf_dir)
    return stored.stored_latest(spark, root, "London", 25).select(
        "city", "temperature", "weather_description", "recorded_at"
    )


@query
def stored_count_by_city(spark, sf_dir):
    root = stored_by_day(spark, sf_dir)
    return stats.count_by_city(stored.read_valid(spark, root), "Tokyo")


@query
def run_counts(spark, sf_dir):
    """Successes and errors of a run, counted while it was written."""
    root = scratch_table(spark, "counts")
    raw = responses(spread_observations(spark, sf_dir), landing.FORECAST)
    sink.write_batch(jobs.records_from(raw), root, "only")
    return sink.run_counts(spark, root)


# --- strict profile ---------------------------------------------------------


@query
def enrich_projection(spark, sf_dir):
    obs = spread_observations(spark, sf_dir)
    joined = conform_uv(lookup.uv_enrich(obs, readable_uv(obs).drop("cycle")))
    return profiles.report_projection(enrich(joined)).drop("processing_timestamp")


@query
def temperature_category(spark, sf_dir):
    return strict(spark, sf_dir).select("obs_id", "temperature_category")


@query
def heat_index(spark, sf_dir):
    return strict(spark, sf_dir).select("obs_id", "heat_index")


@query
def wind_category(spark, sf_dir):
    return strict(spark, sf_dir).select("obs_id", "wind_category")


@query
def comfort_level(spark, sf_dir):
    return strict(spark, sf_dir).select("obs_id", "comfort_level")


@query
def quality_score_binary(spark, sf_dir):
    return strict(spark, sf_dir).select("obs_id", "data_quality_score")


@query
def temperature_fahrenheit(spark, sf_dir):
    return strict(spark, sf_dir).select("obs_id", "temperature_fahrenheit")


@query
def processing_time(spark, sf_dir):
    """One processing time per query, never missing, not in the future."""
    at = F.col("processing_timestamp")
    return strict(spark, sf_dir).agg(
        F.count(at).alias("stamped"),
        (F.min(at) == F.max(at)).alias("same_for_all"),
        (F.max(at) <= F.first(casts.utc_now())).alias("not_in_future"),
    )


# --- zero-default profile ---------------------------------------------------


@query
def zero_default_profile(spark, sf_dir):
    return zero_default(spark, sf_dir).select(
        "obs_id",
        "temperature_category",
        "heat_index",
        "wind_category",
        "comfort_level",
        "data_quality_score",
        "weather_severity_index",
        "is_extreme",
        "recommendation",
        "temperature_fahrenheit",
    )


@query
def quality_score_weighted(spark, sf_dir):
    return zero_default(spark, sf_dir).select("obs_id", "data_quality_score")


@query
def severity_index(spark, sf_dir):
    return zero_default(spark, sf_dir).select("obs_id", "weather_severity_index")


@query
def is_extreme(spark, sf_dir):
    return zero_default(spark, sf_dir).select("obs_id", "is_extreme")


@query
def recommendation(spark, sf_dir):
    return zero_default(spark, sf_dir).select("obs_id", "recommendation")


# --- filters, joins, ordered reads ------------------------------------------


@query
def valid_records(spark, sf_dir):
    return quality.valid_records(observations(spark, sf_dir)).select(
        "obs_id", "city", "temperature", "humidity"
    )


def readable_uv(obs: DataFrame) -> DataFrame:
    return parse.readable(parse.parse_uv(responses(obs, landing.UV)))


def in_cycles(obs: DataFrame) -> DataFrame:
    return obs.withColumn("cycle", F.col("api_timestamp").cast("string"))


@query
def uv_enrich(spark, sf_dir):
    """All readings as one cycle: the latest one of each place counts."""
    obs = spread_observations(spark, sf_dir)
    joined = lookup.uv_enrich(obs, readable_uv(obs).drop("cycle"))
    return conform_uv(joined).select("obs_id", "city", "uv_index")


@query
def uv_enrich_by_cycle(spark, sf_dir):
    """Each record with the reading of its place in its own cycle."""
    obs = in_cycles(spread_observations(spark, sf_dir))
    return conform_uv(lookup.uv_enrich(obs, readable_uv(obs))).select("obs_id", "city", "uv_index")


@query
def uv_enrich_salted(spark, sf_dir):
    """The join used when the lookup is too large to broadcast, hot keys in parts."""
    obs = spread_observations(spark, sf_dir)
    uv = readable_uv(obs).drop("cycle")
    joined = lookup.uv_enrich(obs, uv, broadcast_rows=0, hot_rows=20, spread_by=("obs_id",))
    return conform_uv(joined).select("obs_id", "city", "uv_index")


@query
def city_coverage(spark, sf_dir):
    return lookup.city_coverage(spark, observations(spark, sf_dir), DEPLOYED_CITIES + ", Oslo ")


@query
def latest_by_city(spark, sf_dir):
    found = latest.latest_by_city(
        observations(spark, sf_dir), "London", 25, at="api_timestamp", tie="obs_id"
    )
    return found.select("obs_id", "city", "temperature", "weather_description", "api_timestamp")


@query
def latest_overall(spark, sf_dir):
    found = latest.latest(observations(spark, sf_dir), 10, at="api_timestamp", tie="obs_id")
    return found.select("obs_id", "city", "temperature", "weather_description", "api_timestamp")


@query
def url_param(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", text.url_param(F.col("url"), "page").alias("page_param")
    )


@query
def url_redact(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", text.redact_param(F.col("url"), "utm_source").alias("redacted_url")
    )


# --- aggregations -----------------------------------------------------------


@query
def temp_stats_by_city(spark, sf_dir):
    return stats.temperature_stats(strict(spark, sf_dir))


@query
def weather_patterns(spark, sf_dir):
    return stats.patterns(strict(spark, sf_dir))


@query
def comfort_distribution(spark, sf_dir):
    return stats.distribution_with_share(strict(spark, sf_dir))


@query
def comfort_pct_scalar_total(spark, sf_dir):
    return stats.distribution_of_total(strict(spark, sf_dir))


@query
def temperature_distribution(spark, sf_dir):
    return stats.distribution(strict(spark, sf_dir), "temperature_category")


@query
def wind_distribution(spark, sf_dir):
    return stats.distribution(strict(spark, sf_dir), "wind_category")


@query
def quality_metrics(spark, sf_dir):
    return stats.quality_metrics(strict(spark, sf_dir))


@query
def describe_numeric(spark, sf_dir):
    return stats.describe(observations(spark, sf_dir))


@query
def total_count(spark, sf_dir):
    return stats.total_count(observations(spark, sf_dir))


@query
def data_quality_pct(spark, sf_dir):
    return quality.data_quality(observations(spark, sf_dir))


@query
def count_by_city(spark, sf_dir):
    return stats.count_by_city(observations(spark, sf_dir), "Tokyo")


@query
def profile_distributions(spark, sf_dir):
    return stats.profile_distributions(zero_default(spark, sf_dir))


@query
def extreme_count(spark, sf_dir):
    return stats.extreme_count(zero_default(spark, sf_dir))


@query
def avg_quality(spark, sf_dir):
    return stats.average_quality(zero_default(spark, sf_dir))


@query
def growth_summary(spark, sf_dir):
    return stats.growth(observations(spark, sf_dir), at="api_timestamp")


@query
def batch_summary(spark, sf_dir):
    return stats.batch_summary(strict(spark, sf_dir))


# --- complete jobs and streams ----------------------------------------------


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = spread_observations(spark, sf_dir)
    return responses(obs, landing.FORECAST).unionByName(responses(obs, landing.UV))


def all_reports(found) -> DataFrame:
    """Every report of a run in long form: its name and each row as JSON."""
    long = None
    for name in found:
        report = plain(found[name])
        # Keys in one order and the exponent-free text of numbers, in either engine.
        cells = [
            F.concat(F.lit(c + "="), F.coalesce(F.col(c).cast("string"), F.lit("null")))
            for c in sorted(report.columns)
        ]
        rows = report.select(F.lit(name).alias("report"), F.concat_ws(";", *cells).alias("cells"))
        long = rows if long is None else long.unionByName(rows)
    return long


@query
def job_single(spark, sf_dir):
    run = jobs.run_single(
        landed(spark, sf_dir), scratch_table(spark, "single"), cities=DEPLOYED_CITIES
    )
    return all_reports(run.reports)


@query
def job_with_summary(spark, sf_dir):
    run = jobs.run_with_summary(
        landed(spark, sf_dir), scratch_table(spark, "summary"), cities=DEPLOYED_CITIES
    )
    names = [name for name in run.reports if name != "sample"]  # rows by generated ids
    return all_reports({name: run.reports[name] for name in names})


@query
def job_unknown_kinds(spark, sf_dir):
    """Responses of every kind, known or not: all are stored, set aside or failed."""
    raw = landed(spark, sf_dir)
    kind = F.when(F.col("obs_id") % 11 == 0, "tides").when(F.col("obs_id") % 13 != 0, F.col("kind"))
    root = scratch_table(spark, "kinds")
    jobs.run_plain(raw.withColumn("kind", kind), root, "only")
    reason = F.when(F.col("outcome") == stored.FAILED, F.get("reasons", F.lit(0)))
    rows = stored.read_all(spark, root).select("outcome", F.split_part(reason, F.lit(": "), F.lit(1)).alias("reason"))
    return rows.groupBy("outcome", "reason").agg(stats.row_count())


@query
def job_plain(spark, sf_dir):
    root = scratch_table(spark, "plain")
    jobs.run_plain(landed(spark, sf_dir), root, "only")
    return stored.read_valid(spark, root).select(
        "city", "temperature", "humidity", "uv_index", "recorded_at", "comfort_level"
    )


@query
def job_round_trip(spark, sf_dir):
    return jobs.round_trip(landed(spark, sf_dir), scratch_table(spark, "trip")).select(
        "city", "temperature", "recorded_at"
    )


STREAM_FILES = 6


def landed_files(spark: SparkSession, sf_dir: str) -> str:
    """All responses as landed files, readings in files of their own after the records."""
    path = scratch_table(spark, "landed")
    obs = spread_observations(spark, sf_dir)
    for kind in (landing.FORECAST, landing.UV):
        raw = responses(obs, kind).repartition(STREAM_FILES, "obs_id")
        landing.write_landing(raw, path)
    return path


def stream_once(spark: SparkSession, sf_dir: str) -> str:
    """Read landed files as a stream, two a micro-batch, run the cycle job on each, end it."""
    root = scratch_table(spark, "stream")
    path = landed_files(spark, sf_dir)

    def files() -> DataFrame:
        return landing.stream_landing(spark, path, files_per_batch=2)

    cycles = start_cycles(files(), root, f"{root}.checkpoint", interval=None, cities=DEPLOYED_CITIES)
    cycles.awaitTermination()
    flush(files(), root, f"{root}.checkpoint", cities=DEPLOYED_CITIES)
    return root


@query
def stream_available_now(spark, sf_dir):
    return stored.read_valid(spark, stream_once(spark, sf_dir)).select(*REPEATABLE)


@query
def stream_landed_cycles(spark, sf_dir):
    """Readings that come after their records, several cycles per place: who got which."""
    rows = stored.read_valid(spark, stream_once(spark, sf_dir))
    return rows.groupBy("city", F.col("recorded_at").cast("date").alias("cycle"), "uv_index").agg(
        stats.row_count()
    )


@query
def stream_failures(spark, sf_dir):
    """Bad responses of a stream end up beside the good ones."""
    rows = stored.read_all(spark, stream_once(spark, sf_dir))
    return rows.groupBy("outcome").agg(stats.row_count())


def streamed_cells(spark: SparkSession, sf_dir: str) -> str:
    """Cells of all cycles.  The files hold times in any order, so windows stay open for
    longer than the table's years and are closed at the end."""
    path = scratch_table(spark, "cells")
    landed_at = landed_files(spark, sf_dir)
    options = {"lateness": timedelta(days=36500), "every": "1 day"}

    def files() -> DataFrame:
        return landing.stream_landing(spark, landed_at, files_per_batch=6)

    reports.start_reports(files(), path, f"{path}.checkpoint", interval=None, **options).awaitTermination()
    reports.close_reports(files(), path, f"{path}.checkpoint", **options)
    return path


@query
def stream_cycle_report(spark, sf_dir):
    """Comfort levels per cycle, added up."""
    found = reports.cycle_comfort(spark, streamed_cells(spark, sf_dir))
    return found.groupBy("comfort_level").agg(F.sum("row_count").alias("row_count"))


@query
def stream_cycle_stats(spark, sf_dir):
    """Temperatures per day and city from the cells of all cycles."""
    cells = reports.read_cells(spark, streamed_cells(spark, sf_dir))
    day = F.substring("cycle", 1, 10).alias("day")
    merged = moments.merged(cells.select("*", day), "day", "city", measures=("temperature",))
    return merged.select("day", "city", "row_count", *moments.temperature_columns())


@query
def stream_dead_letters(spark, sf_dir):
    """A database that refuses the rows of some files: those are dead letters, all others
    are stored."""
    root, path = scratch_table(spark, "stream"), scratch_table(spark, "landed")
    raw = responses(spread_observations(spark, sf_dir), landing.FORECAST)
    for own in (F.col("city") == "Tokyo", F.col("city") != "Tokyo"):
        landing.write_landing(raw.filter(own).repartition(2, "obs_id"), path)

    # A response that failed is told by the city it asked for.
    asked = F.coalesce(F.get_json_object("raw_record", "$.requested_city"), F.col("city"))

    def refuse(rows: DataFrame) -> None:
        # Of a file, failures come in an earlier micro-batch than records that wait.
        if not stored.read_all(spark, root).filter(asked == "Tokyo").isEmpty():
            raise ValueError("refused")

    files = landing.stream_landing(spark, path)
    flush(files, root, f"{root}.checkpoint", cities=DEPLOYED_CITIES, database=refuse, attempts=1)
    rows = stored.read_all(spark, root).select("outcome")
    dead = dead_letters(spark, root).select(F.lit("dead").alias("outcome"))
    return rows.unionByName(dead).groupBy("outcome").agg(stats.row_count())
