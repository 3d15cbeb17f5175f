"""Jobs and streams over landed responses."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger.catalog.observations import observations, responses
from skyledger.operators import stats
from skyledger.operators.enrich import enrich
from skyledger.plans import jobs
from skyledger.schemas import LANDING
from skyledger.sinks.table import run_counts
from skyledger.sources import landing, stored
from skyledger.streaming import reports
from skyledger.streaming.cycle import dead_letters, flush, run_supervised, start_cycles

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def raw(spark):
    obs = observations(spark, SMALL)
    return responses(obs, landing.FORECAST).unionByName(responses(obs, landing.UV))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def test_no_responses_ends_quietly(spark, root):
    result = jobs.run_single(spark.createDataFrame([], LANDING), root)
    assert result.counts is None and result.reports == {}


def test_single(spark, raw, root):
    result = jobs.run_single(raw, root, "r1", cities="London,Oslo")
    counts = result.counts
    assert counts.stored + counts.errors == 1000 and counts.failed > 0 and counts.rejected > 0
    assert set(result.reports) == {
        "total_count", "city_coverage", "data_quality", "describe", "temperature_stats",
        "patterns", "comfort_distribution",
    }
    assert result.reports["total_count"].first()["total_records"] == counts.stored
    coverage = {r["city"]: r["row_count"] for r in result.reports["city_coverage"].collect()}
    assert coverage["Oslo"] == 0 and coverage["London"] > 0
    # Reports see every record that was read, as it was before the store's rules.
    seen = result.reports["comfort_distribution"].agg(F.sum("row_count")).first()[0]
    assert seen == counts.stored + counts.rejected
    direct = stats.temperature_stats(
        enrich(jobs.records_from(raw))
        .filter("fetch_error IS NULL AND parse_error IS NULL")
        .withColumnRenamed("city", "city_name")
    )
    assert sorted(result.reports["temperature_stats"].collect()) == sorted(direct.collect())


def test_summary_of_one_batch_only(spark, raw, root):
    jobs.run_with_summary(raw, root, "r1")
    result = jobs.run_with_summary(raw.filter("obs_id < 100"), root, "r2")
    total = result.reports["batch_summary"].filter("section = 'quality_score'").first()["row_count"]
    assert total == result.counts.stored + result.counts.rejected < 100
    assert result.reports["total_count"].first()["total_records"] > 800
    assert result.reports["sample"].count() == 20


def test_zero_default_profile_is_stored(spark, raw, root):
    result = jobs.run_batch(raw, root, profile="zero_default")
    rows = stored.read_valid(spark, root)
    assert rows.filter("is_extreme IS NULL OR recommendation IS NULL").count() == 0
    assert {"profile_distributions", "extreme_count", "average_quality"} <= set(result.reports)


def test_plain_stores_without_enrichment(spark, raw, root):
    result = jobs.run_plain(raw, root)
    rows = stored.read_valid(spark, root)
    assert rows.count() == result.counts.stored
    assert rows.filter("comfort_level IS NOT NULL OR heat_index IS NOT NULL").count() == 0
    assert rows.filter("uv_index IS NOT NULL").count() > 0
    assert set(result.reports) == {"total_count", "city_coverage"}


def test_round_trip_finds_the_newest_row(spark, raw, root):
    row = jobs.round_trip(raw, root).first()
    newest = stored.read_valid(spark, root).agg(F.max("recorded_at")).first()[0]
    assert row["city"] == "London" and row["recorded_at"] == newest


def test_failures_are_kept_with_their_reason_and_no_key(spark, raw, root):
    jobs.run_single(raw, root)
    failed = stored.read_all(spark, root).filter("outcome = 'failed'").collect()
    reasons = {r["reasons"][0].split(":")[0] for r in failed}
    assert reasons == {
        "invalid API key", "city not found", "rate limit exceeded",
        "request failed with status 500", "malformed body",
    }
    for row in failed:
        kept = json.loads(row["raw_record"])
        assert kept["requested_city"] and "appid=***" in kept["request_url"]


def land(spark, raw, path, condition):
    landing.write_landing(raw.filter(condition), path)


def test_stream_takes_only_new_files(spark, raw, root, tmp_path):
    path = str(tmp_path / "landing")
    reports = []

    def run():
        query = start_cycles(
            landing.stream_landing(spark, path),
            root,
            str(tmp_path / "checkpoint"),
            interval=None,
            on_result=reports.append,
        )
        query.awaitTermination()

    land(spark, raw, path, "obs_id < 400")
    run()
    first = stored.read_all(spark, root).count()
    run()  # nothing new
    assert stored.read_all(spark, root).count() == first == 400
    land(spark, raw, path, "obs_id >= 400")
    run()
    assert stored.read_all(spark, root).count() == 1000
    assert run_counts(spark, root).count() == len(reports) == 2
    ids = stored.read_valid(spark, root)
    assert ids.select("id").distinct().count() == ids.count()
    # A cycle's report covers that cycle's own records.
    sizes = [r.reports["comfort_distribution"].agg(F.sum("row_count")).first()[0] for r in reports]
    assert sizes == [r.counts.stored + r.counts.rejected for r in reports] and sizes[0] < 400


def test_stream_on_an_interval_survives_bad_responses(spark, root, tmp_path):
    path = str(tmp_path / "landing")
    good = '{"city":{"name":"A"},"list":[{"main":{"temp":1}}]}'
    cycles = [[("nope", 200), (None, 500)], [(good, 200)]]

    def drop(number):
        rows = [("forecast", "A", "https://x/?q=A", status, body, None, None) for body, status in cycles[number]]
        landing.write_landing(spark.createDataFrame(rows, LANDING), path)

    drop(0)
    query = start_cycles(
        landing.stream_landing(spark, path), root, str(tmp_path / "checkpoint"), stream="timed", interval=1
    )
    try:
        query.processAllAvailable()
        drop(1)
        query.processAllAvailable()
        assert query.exception() is None
    finally:
        query.stop()
    outcomes = {r["outcome"]: r["count"] for r in stored.read_all(spark, root).groupBy("outcome").count().collect()}
    assert outcomes == {"failed": 2, "valid": 1}


def reading(number, cycle, value):
    url = f"https://x/?lat={number}.5&lon=7.25&appid=k"
    return ("uv", None, url, 200, f'{{"value":{value}}}', None, cycle)


def forecast(number, cycle):
    body = f'{{"city":{{"name":"C{number}","coord":{{"lat":{number}.5,"lon":7.25}}}},"list":[{{"main":{{"temp":{number}}}}}]}}'
    return ("forecast", f"C{number}", f"https://x/?q=C{number}", 200, body, None, cycle)


@pytest.mark.parametrize("files_per_batch", [1, 2, 1000])
def test_readings_that_come_later_are_waited_for(spark, root, tmp_path, files_per_batch):
    """Four cycles of three places, readings last and none for the last cycle."""
    path = str(tmp_path / "landing")
    for cycle in "abcd":
        landing.write_landing(spark.createDataFrame([forecast(n, cycle) for n in range(3)], LANDING).coalesce(1), path)
    for k, cycle in enumerate("abc"):
        rows = [reading(n, cycle, n + k) for n in range(3)]
        landing.write_landing(spark.createDataFrame(rows, LANDING).coalesce(1), path)
    files = landing.stream_landing(spark, path, files_per_batch=files_per_batch)
    start_cycles(files, root, str(tmp_path / "checkpoint"), interval=None).awaitTermination()
    rows = stored.read_valid(spark, root).select("city", "uv_index").collect()
    expected = sorted((f"C{n}", n + k) for n in range(3) for k in range(3))
    assert sorted((r["city"], int(r["uv_index"])) for r in rows) == expected
    flushed = []
    flush(files, root, str(tmp_path / "checkpoint"), on_result=flushed.append)
    assert [r.counts.stored for r in flushed] == [3]
    with pytest.raises(ValueError, match="has been flushed"):
        start_cycles(files, root, str(tmp_path / "checkpoint"), interval=None)
    rows = stored.read_valid(spark, root)
    assert rows.count() == 12 and rows.filter("uv_index IS NULL").count() == 3
    ids = rows.select("id")
    assert ids.distinct().count() == 12
    assert not (tmp_path / "table.waiting").exists()


def test_state_has_few_parts_and_rows_of_a_day_share_a_file(spark, raw, root, tmp_path):
    path, checkpoint = str(tmp_path / "landing"), tmp_path / "checkpoint"
    landing.write_landing(raw.repartition(8, "obs_id"), path)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        files = landing.stream_landing(spark, path)
        start_cycles(files, root, str(checkpoint), interval=None).awaitTermination()
        flush(files, root, str(checkpoint))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    parts = [p.name for p in (checkpoint / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(parts) == 2 * spark.sparkContext.defaultParallelism
    kept = stored.read_all(spark, root)
    assert kept.count() == 1000
    files = [p for p in (tmp_path / "table").glob("batch=*/outcome=*/*/*.parquet")]
    assert len(files) == kept.select("batch", "outcome", "recorded_on").distinct().count() > 8


def test_a_failed_cycle_starts_again_from_its_checkpoint(spark, root, tmp_path):
    path = str(tmp_path / "landing")
    landing.write_landing(spark.createDataFrame([("forecast", "A", "u", 500, None, None, "a")], LANDING), path)
    calls = []

    def database(rows):
        calls.append(rows.count())
        if len(calls) == 1:
            raise RuntimeError("the database is away")

    def start():
        return start_cycles(
            landing.stream_landing(spark, path), root, str(tmp_path / "checkpoint"), interval=None,
            database=database,
        )

    run_supervised(start)
    assert len(calls) == 2
    assert stored.read_all(spark, root).count() == 1


def test_every_response_is_accounted_for(spark, root):
    good = forecast(1, "a")
    rows = [good, reading(1, "a", 4), ("tides", *good[1:]), (None, *good[1:])]
    counts = jobs.run_single(spark.createDataFrame(rows, LANDING), root, "r").counts
    assert (counts.stored, counts.rejected, counts.failed) == (1, 0, 2)
    reasons = stored.read_all(spark, root).filter("outcome = 'failed'").select(F.explode("reasons")).collect()
    assert sorted(r[0] for r in reasons) == ["unknown kind: none", "unknown kind: tides"]


def test_reports_see_what_was_read(spark, root):
    """Measures with more digits than the store has, and one too large for it."""

    def row(value):
        body = f'{{"city":{{"name":"A"}},"list":[{{"main":{{"temp":{value}}},"wind":{{"speed":{value}}}}}]}}'
        return ("forecast", "A", "u", 200, body, None, "a")

    raw = spark.createDataFrame([row(v) for v in ("-0.004", "12.345", "123456.7")], LANDING)
    result = jobs.run_single(raw, root, "r")
    assert (result.counts.stored, result.counts.rejected) == (2, 1)
    found = result.reports["temperature_stats"].first()
    assert (found["min_temperature"], found["max_temperature"]) == (-0.004, 123456.7)
    wind = {r["measure"]: r for r in result.reports["describe"].collect()}["wind_speed"]
    assert (wind["n"], wind["max"]) == (3, 123456.7)


def test_a_cycle_reads_only_its_own_folder(spark, raw, root):
    for name in ("a", "b"):
        result = jobs.run_single(raw.filter("obs_id < 60"), root, name)
    files = jobs.processed(spark, root, result.counts.batch).inputFiles()
    assert files and all("/batch=b/" in f for f in files)


def test_a_reading_counts_once_and_rows_without_a_place_do_not_wait(spark, root, tmp_path):
    path, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")

    def run(rows):
        landing.write_landing(spark.createDataFrame(rows, LANDING).coalesce(1), path)
        start_cycles(landing.stream_landing(spark, path), root, checkpoint, interval=None).awaitTermination()
        return sorted((r["city"], r["uv_index"]) for r in stored.read_valid(spark, root).collect())

    nowhere = ("forecast", "N", "u", 200, '{"city":{"name":"N"},"list":[]}', None, "a")
    assert run([forecast(1, "a"), nowhere]) == [("N", None)]
    assert run([reading(1, "a", 4)]) == [("C1", 4), ("N", None)]
    # A second reading of the same place and cycle changes and repeats nothing.
    assert run([reading(1, "a", 5), forecast(2, "a")]) == [("C1", 4), ("N", None)]
    assert run([reading(2, "b", 5), reading(2, "a", 6)]) == [("C1", 4), ("C2", 6), ("N", None)]


def test_a_file_that_cannot_be_stored_does_not_end_the_stream(spark, root, tmp_path):
    path, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    for cycle in "abcde":
        rows = [("forecast", "N", "u", 200, f'{{"city":{{"name":"{cycle}"}},"list":[]}}', None, cycle)] * 2
        landing.write_landing(spark.createDataFrame(rows, LANDING).coalesce(1), path)
    tries = []

    def database(rows):
        names = {r["city"] for r in rows.collect()}
        tries.append(names)
        if "c" in names:
            raise ValueError("c is refused")

    def start():
        files = landing.stream_landing(spark, path)
        return start_cycles(files, root, checkpoint, interval=None, database=database, attempts=2)

    start().awaitTermination()
    cities = [r["city"] for r in stored.read_valid(spark, root).collect()]
    assert sorted(cities) == sorted("abde" * 2)
    dead = dead_letters(spark, root).collect()
    assert len(dead) == 2 and all("c is refused" in r["error"] for r in dead)
    assert all(json.loads(r["raw_record"])["cycle"] == "c" and r["source_file"].endswith(".json") for r in dead)
    # The stream goes on with what comes next.
    assert tries[0] == tries[1] == set("abcde")
    landing.write_landing(spark.createDataFrame([("forecast", "N", "u", 500, None, None, "f")], LANDING), path)
    start().awaitTermination()
    assert stored.read_all(spark, root).filter("outcome = 'failed'").count() == 1
    ids = stored.read_valid(spark, root).select("id")
    assert ids.distinct().count() == 8


def test_reports_of_closed_cycles_and_a_late_record(spark, tmp_path):
    path, cells, checkpoint = (str(tmp_path / name) for name in ("landing", "cells", "checkpoint"))
    options = {"every": "1 hour", "lateness": timedelta(hours=2)}

    def run(cycle, at, *values):
        rows = []
        for value in values:
            body = f'{{"city":{{"name":"A"}},"list":[{{"main":{{"temp":{value},"humidity":50}}}}]}}'
            rows.append(("forecast", "A", "u", 200, body, at, cycle))
        landing.write_landing(spark.createDataFrame(rows, LANDING).coalesce(1), path)
        files = landing.stream_landing(spark, path)
        reports.start_reports(files, cells, checkpoint, interval=None, **options).awaitTermination()
        found = reports.cycle_temperature_stats(spark, cells).collect()
        return {r["cycle"]: (r["avg_temperature"], r["temp_stddev"]) for r in found}

    noon = datetime(2024, 3, 1, 12, 10)
    assert run("a", noon, 18, 20) == {}
    # Late, but within the wait: still in its cycle's report.
    assert run("b", noon + timedelta(minutes=90), 5) == {}
    assert run("a", noon + timedelta(minutes=5), 22) == {}
    closed = {"a": (20.0, 2.0), "b": (5.0, None)}
    assert run("c", noon + timedelta(hours=4), 7) == closed
    # Too late: the report is closed and stays as it is.
    assert run("a", noon, 90) == closed
    reports.close_reports(landing.stream_landing(spark, path), cells, checkpoint, **options)
    found = reports.cycle_patterns(spark, cells).select("cycle", "temperature_category", "row_count").collect()
    assert [tuple(r) for r in found] == [("a", "Mild", 2), ("a", "Warm", 1), ("b", "Cold", 1), ("c", "Cold", 1)]
    comfort = {(r["cycle"], r["comfort_level"]): r["percentage"] for r in reports.cycle_comfort(spark, cells).collect()}
    assert comfort[("a", "Comfortable")] == 100.0
