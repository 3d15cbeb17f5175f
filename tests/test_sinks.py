"""Quarantine, replay, ids, and a database round trip."""

from __future__ import annotations

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from skyledger.operators import latest, moments, quality, stats
from skyledger.operators.enrich import enrich
from skyledger.schemas import RECORD
from skyledger.sinks import jdbc, table
from skyledger.sources import stored

AT = datetime.datetime(2024, 3, 1, 12, 0, 0, 123456)
COLUMNS = (
    "n int, city string, humidity int, wind_direction int, cloudiness int,"
    " temperature decimal(38,18), country string, recorded_at timestamp_ntz"
)


def record(n, city="A", humidity=50, wind=10, clouds=10, temperature="1.5", country="XX", at=AT):
    return (n, city, humidity, wind, clouds, Decimal(temperature), country, at)


MIXED = [
    (record(1), None),
    (record(2, city=None), "city missing"),
    (record(3, humidity=-1), "humidity out of range"),
    (record(4, humidity=101), "humidity out of range"),
    (record(5, wind=-1), "wind_direction out of range"),
    (record(6, wind=361), "wind_direction out of range"),
    (record(7, clouds=101), "cloudiness out of range"),
    (record(8, humidity=None, wind=None, clouds=None), None),
    (record(9, humidity=0, wind=0, clouds=0), None),
    (record(10, humidity=100, wind=360, clouds=100), None),
    (record(11, temperature="123456.7"), "temperature does not fit"),
    (record(12, temperature="999.994"), None),
    (record(13, country="longer than ten"), "country too long"),
    (record(14, humidity=101, clouds=-1), "humidity out of range,cloudiness out of range"),
]


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame([row for row, _ in MIXED], COLUMNS)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def test_reasons(mixed):
    got = quality.check(mixed).select("n", "is_valid", F.array_join("reasons", ",")).collect()
    assert {r[0]: r[2] for r in got} == {row[0]: reason for row, reason in MIXED}
    assert all(r["is_valid"] == (r[2] is None) for r in got)


def test_bad_rows_do_not_stop_good_ones(spark, mixed, root):
    counts = table.write_batch(mixed, root, "b1")
    bad = [row for row, reason in MIXED if reason]
    assert (counts.stored, counts.rejected, counts.failed) == (len(MIXED) - len(bad), len(bad), 0)
    assert counts.errors == len(bad)
    aside = stored.read_quarantine(spark, root)
    kept = aside.select(F.get_json_object("raw_record", "$.n").cast("int").alias("n"), "reasons")
    assert {r["n"]: ",".join(r["reasons"]) for r in kept.collect()} == {
        row[0]: reason for row, reason in MIXED if reason
    }
    # What did not fit is still there, in full.
    wide = aside.filter(F.array_contains("reasons", "temperature does not fit")).first()
    assert "123456.7" in wide["raw_record"]


def test_writing_a_batch_again_replaces_it(spark, mixed, root):
    table.write_batch(mixed, root, "b1")
    first = stored.read_valid(spark, root).orderBy("id").drop("created_at", "updated_at").collect()
    table.write_batch(mixed, root, "b1")
    again = stored.read_valid(spark, root).orderBy("id").drop("created_at", "updated_at").collect()
    assert first == again
    table.write_batch(mixed, root, "b2")
    assert stored.read_valid(spark, root).count() == 2 * len(first)
    assert stored.read_valid(spark, root, "b2").count() == len(first)
    runs = {r["batch"]: (r["stored"], r["errors"]) for r in table.run_counts(spark, root).collect()}
    assert runs == {"b1": (5, 9), "b2": (5, 9)}


def test_ids_are_unique_across_batches_and_tasks(spark, root):
    rows = spark.range(5000).repartition(7).select(
        F.lit("A").alias("city"), F.col("id").alias("n"), F.lit(AT).cast("timestamp_ntz").alias("recorded_at")
    )
    ends = [table.write_batch(rows, root, name).last_id for name in ("a", "b", "c")]
    ids = [r["id"] for r in stored.read_valid(spark, root).select("id").collect()]
    assert len(ids) == len(set(ids)) == 15000 and min(ids) >= 1
    assert ends == sorted(ends) and ends[-1] == max(ids)


def test_record_time_is_kept_or_set(spark, root):
    rows = spark.createDataFrame([record(1), record(2, at=None)], COLUMNS)
    table.write_batch(rows, root, "b")
    times = [r["recorded_at"] for r in stored.read_valid(spark, root).orderBy("recorded_at").collect()]
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    assert times[0] == AT and abs((now - times[1]).total_seconds()) < 120


def test_every_row_is_written_once(spark, mixed, root):
    counts = table.write_batch(mixed.repartition(5), root, "b")
    assert (counts.stored, counts.rejected) == (5, 9)
    assert stored.read_all(spark, root).count() == len(MIXED)


def test_a_new_table_reads_as_empty(spark, root):
    table.ensure_table(spark, root)
    assert stored.read_valid(spark, root).count() == 0
    assert stored.read_valid(spark, root).schema == RECORD
    assert table.run_counts(spark, root).count() == 0
    table.ensure_table(spark, root)


def test_an_interrupted_batch_is_hidden_and_its_ids_stay_its_own(spark, mixed, root, monkeypatch):
    table.write_batch(mixed, root, "a")
    with monkeypatch.context() as broken:
        real = table._put_entry

        def fails_at_the_end(session, path, entry):
            if entry[3]:
                raise RuntimeError("stopped before the ledger was complete")
            real(session, path, entry)

        broken.setattr(table, "_put_entry", fails_at_the_end)
        with pytest.raises(RuntimeError):
            table.write_batch(mixed, root, "b")
    assert {r["batch"] for r in stored.read_all(spark, root).select("batch").collect()} == {"a"}
    table.write_batch(mixed, root, "c")
    table.write_batch(mixed, root, "b")
    table.write_batch(mixed, root, "a")
    ids = stored.read_valid(spark, root).select("id")
    assert ids.distinct().count() == ids.count() == 3 * table.write_batch(mixed, root, "a").stored


@pytest.mark.parametrize("tasks", [1, 40])
def test_ids_are_dense_however_tasks_are_cut(spark, root, tasks):
    """One task with all rows, or many with almost none."""
    rows = spark.range(0, 3000, 1, tasks).select(
        F.when(F.col("id") % 7 > 0, "A").alias("city"), F.lit(AT).cast("timestamp_ntz").alias("recorded_at")
    )
    first = table.write_batch(rows, root, "a")
    again = table.write_batch(rows.filter("city IS NULL OR city = 'A'").limit(2900), root, "a")
    second = table.write_batch(rows, root, "b")
    assert first.last_id == first.stored == 2571 and again.last_id == again.stored
    assert second.last_id == 2 * 2571
    ids = sorted(r["id"] for r in stored.read_valid(spark, root, "b").select("id").collect())
    assert ids == list(range(2572, 2 * 2571 + 1))


def test_a_larger_replay_gets_a_range_of_its_own(spark, root):
    def rows(n):
        return spark.range(n).select(F.lit("A").alias("city"), F.lit(AT).cast("timestamp_ntz").alias("recorded_at"))

    table.write_batch(rows(5), root, "a")
    table.write_batch(rows(5), root, "b")
    table.write_batch(rows(8), root, "a")
    ids = sorted(r["id"] for r in stored.read_valid(spark, root).select("id").collect())
    assert ids == [*range(6, 11), *range(11, 19)]


def test_a_withdrawn_batch_is_hidden(spark, mixed, root):
    table.write_batch(mixed, root, "a")
    table.write_batch(mixed, root, "b")
    table.withdraw(spark, root, "a")
    table.withdraw(spark, root, "none")
    assert {r["batch"] for r in stored.read_all(spark, root).select("batch").collect()} == {"b"}
    assert moments.total_count(stored.read_cities(spark, root)).first()[0] == 5


def test_no_rows_leave_no_batch_unless_wanted(spark, mixed, root):
    nothing = mixed.limit(0)
    assert table.write_batch(nothing, root, "a", keep_empty=False).stored == 0
    assert stored.read_ledger(spark, root).count() == 0
    assert table.write_batch(nothing, root, "a").last_id == 0
    assert table.run_counts(spark, root).count() == 1


def test_summaries_read_no_record(spark, mixed, root):
    for name in "abc":
        table.write_batch(mixed, root, name)
    parts = stored.read_cities(spark, root)
    total = moments.total_count(parts)
    assert total.first()[0] == 15 and moments.count_by_city(parts, "A").first()[0] == 15
    assert moments.count_by_city(parts, "Z").first()[0] == 0
    # Every file that is read is the ledger's; none is of the table.
    files = total.inputFiles()
    assert files and all(f"{root}.ledger/" in f for f in files)
    assert "recorded_at" not in total._jdf.queryExecution().executedPlan().toString()


def test_moments_of_parts_are_those_of_all(spark, root):
    draw = random.Random(4)
    rows = [
        (draw.choice("AB"), Decimal(draw.randint(-3000, 4000)) / 100 if k % 5 else None, 1013, draw.choice([3, 50]))
        for k in range(300)
    ]
    kinds = "city string, temperature decimal(5,2), pressure int, humidity int"
    every = spark.createDataFrame(rows, kinds).withColumn("wind_speed", F.lit(None).cast("decimal(5,2)"))
    for k in range(3):
        part = spark.createDataFrame(rows[k::3], kinds)
        table.write_batch(part.withColumn("recorded_at", F.lit(AT).cast("timestamp_ntz")), root, f"b{k}")
    parts = stored.read_cities(spark, root)
    assert sorted(moments.temperature_stats(parts).collect()) == sorted(
        stats.temperature_stats(every, "city").collect()
    )
    found = {r["measure"]: tuple(r)[1:] for r in moments.describe(parts).collect()}
    assert found == {r["measure"]: tuple(r)[1:] for r in stats.describe(every).collect()}
    # Equal values have no deviation at all, not a rounding's worth of one.
    assert found["pressure"][2] == 0.0 and found["wind_speed"] == (0, None, None, None, None)


def test_newest_of_every_city(spark, root):
    rows = [record(k, city="ABC"[k % 3 if k < 9 else 0], at=AT + datetime.timedelta(hours=k)) for k in range(40)]
    table.write_batch(spark.createDataFrame(rows, COLUMNS), root, "only")
    newest = stored.stored_latest_per_city(spark, root, 2)
    hours = sorted((r["city"], (r["recorded_at"] - AT).seconds // 3600 + 24 * (r["recorded_at"] - AT).days) for r in newest.collect())
    assert hours == [("A", 38), ("A", 39), ("B", 4), ("B", 7), ("C", 5), ("C", 8)]
    plan = stored.stored_latest_per_city(spark, root, 2)._jdf.queryExecution().executedPlan().toString()
    # Limited within each task, before rows are dealt out by city, and after it.
    first, dealt, last = (plan.index(x) for x in ("Final", "Exchange hashpartitioning(city", "Partial"))
    assert plan.count("WindowGroupLimit") == 2 and first < dealt < last


def test_days_are_folders_and_cities_lie_together(spark, root):
    rows = [record(k, city="AB"[k % 2], at=AT + datetime.timedelta(days=k % 3)) for k in range(60)]
    table.write_batch(spark.createDataFrame(rows, COLUMNS), root, "only")
    newest = stored.stored_latest(spark, root, "A", 5, since=(AT + datetime.timedelta(days=2)).date())
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "recorded_on" in plan.split("PartitionFilters")[1][:300]
    assert "EqualTo(city,A)" in plan
    assert {r["recorded_at"].date() for r in newest.collect()} == {(AT + datetime.timedelta(days=2)).date()}
    cities = [r["city"] for r in spark.read.parquet(f"{root}/batch=only/outcome=valid").filter(
        F.col("recorded_on") == (AT.date())).collect()]
    assert cities == sorted(cities)


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_database_round_trip(spark, root):
    """Embedded database inside this process: no server, no port."""
    url = "jdbc:derby:memory:records;create=true"
    rows = enrich(
        spark.range(3000).select(
            F.concat(F.lit("C"), F.col("id") % 3).alias("city"),
            (F.col("id") % 4000 / 100).cast("decimal(5,2)").alias("temperature"),
            (F.col("id") % 101).cast("int").alias("humidity"),
            F.lit(1000).alias("pressure"),
            F.lit(None).cast("decimal(5,2)").alias("wind_speed"),
            # This database's dialect cannot bind a NULL to sized text.
            F.lit("fog").alias("weather_description"),
            F.lit("Mist").alias("weather_main"),
            F.lit("XX").alias("country"),
            (F.lit(AT).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("recorded_at"),
        ),
        "zero_default",
    )
    table.write_batch(rows, root, "b")
    accepted = stored.read_valid(spark, root)
    jdbc.ensure_table(spark, url, "weather_data", DERBY)
    read = stored.read_jdbc(spark, url, "weather_data", DERBY, None)
    assert read.count() == 0 and read.dtypes == stored.read_valid(spark, root).dtypes
    jdbc.append(accepted, url, "weather_data", DERBY, "b", connections=2)
    assert read.orderBy("id").collect() == accepted.orderBy("id").collect()
    # Sent again, as a whole or with a task's rows twice, it adds nothing.
    jdbc.append(accepted, url, "weather_data", DERBY, "b", connections=2)
    jdbc.stage(accepted, url, "twice", DERBY, 2)
    jdbc.stage(accepted.filter("id % 2 = 0"), url, "twice", DERBY, 2, mode="append")
    jdbc.take_over(spark, url, "weather_data", "twice", DERBY)
    assert read.count() == 3000
    top = int(accepted.agg(F.max("id")).first()[0])
    parallel = stored.read_jdbc(spark, url, "weather_data", DERBY, "id", (1, top), 4)
    assert parallel.rdd.getNumPartitions() == 4 and parallel.count() == 3000
    found = stored.read_jdbc(spark, url, "weather_data", DERBY)
    assert found.rdd.getNumPartitions() == 8 and found.count() == 3000
    newest = jdbc.newest(read, "C1", 5)
    assert newest.collect() == latest.latest_by_city(accepted, "C1", 5).collect()
    plan = newest._jdf.queryExecution().toString()
    assert "PushedFilters: [*IsNotNull(city), *EqualTo(city,C1)]" in plan.replace("CITY", "city")


def told(spark, rows):
    """Complete records for the database: (id, city, humidity)."""
    wide = spark.createDataFrame(rows, "id long, city string, humidity int")
    text = {c: F.lit("x") for c in (
        "country", "weather_main", "weather_description", "temperature_category", "wind_category",
        "comfort_level", "recommendation",
    )}
    return wide.withColumns(text)


def test_the_database_keeps_its_own_rules(spark):
    url = "jdbc:derby:memory:rules;create=true"
    jdbc.ensure_table(spark, url, "obs", DERBY)
    jdbc.ensure_table(spark, url, "obs", DERBY)
    assert jdbc.exists(spark, url, "obs", DERBY) and not jdbc.exists(spark, url, "other", DERBY)
    with pytest.raises(Exception, match="(?i)check constraint"):
        jdbc.append(told(spark, [(1, "A", 50), (2, "A", 101)]), url, "obs", DERBY, "bad", connections=1)
    read = stored.read_jdbc(spark, url, "obs", DERBY, None)
    # All or none: the sound row of that batch is not there either.
    assert read.count() == 0
    with pytest.raises(Exception, match="(?i)null"):
        jdbc.run_statement(spark, url, DERBY, 'INSERT INTO obs ("id") VALUES (9)')
    jdbc.append(told(spark, [(1, "A", 50), (2, "A", 100)]), url, "obs", DERBY, "good", connections=1)
    rows = read.collect()
    assert {r["id"] for r in rows} == {1, 2} and all(r["created_at"] is not None for r in rows)
    with pytest.raises(Exception, match="(?i)unique|primary"):
        jdbc.run_statement(spark, url, DERBY, """INSERT INTO obs ("id", "city") VALUES (1, 'B')""")


def test_parts_of_a_table_are_even_however_ids_lie(spark):
    """A gap as an interrupted batch once left it, and ids far apart."""
    url = "jdbc:derby:memory:gaps;create=true"
    ids = [*range(1, 401), *((1 << 50) + 1000 * k for k in range(700)), *range(1 << 60, (1 << 60) + 100)]
    jdbc.append(told(spark, [(i, "A", 1) for i in ids]), url, "obs", DERBY, connections=2)
    rows = stored.read_jdbc(spark, url, "obs", DERBY, partitions=6)
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    counts = sorted(r["count"] for r in sizes)
    assert len(counts) == 6 and sum(counts) == len(ids) and counts[-1] <= 2 * counts[len(counts) // 2]
    assert sorted(r["id"] for r in rows.select("id").collect()) == ids
    few = stored.read_jdbc(spark, url, "obs", DERBY, partitions=6).filter("id <= 3")
    assert {r["id"] for r in few.collect()} == {1, 2, 3}


def test_the_first_id_is_no_part_of_the_code_for_the_records(spark):
    """Batches whose ids start elsewhere run the same generated code."""
    placed = spark.range(6).selectExpr(
        "CAST(id % 2 AS STRING) AS _file", "id DIV 2 AS _row", "IF(id < 4, 'valid', 'failed') AS outcome"
    )
    shifts = spark.createDataFrame([("0", 0), ("1", 2)], "_file string, _shift bigint")
    numbered = table._numbered(placed, shifts, 987654, 2)
    assert sorted(r["id"] for r in numbered.filter("outcome = 'valid'").collect()) == [987654, 987655, 987656, 987657]
    assert numbered.filter("outcome = 'failed' AND id IS NOT NULL").isEmpty()
    above, below = numbered._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)
    assert "987654" in below and "987654" not in above
