"""The broadcast and the salted join give the same rows, hot keys included."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from skyledger.operators import lookup


@pytest.fixture
def facts(spark):
    """A third of the rows on one coordinate pair, another third without one."""
    place = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
        F.col("id") % 50
    )
    return spark.range(9000).select(
        "id", place.cast("decimal(38,18)").alias("latitude"), place.cast("decimal(38,18)").alias("longitude")
    )


@pytest.fixture
def uv(spark):
    """Three readings per place, the last one counts; a tie goes to the higher value."""
    rows = [
        (p, p, f"2024-01-0{1 + (r > 0)} 00:00:00", p + r) for p in range(0, 40) for r in range(3)
    ]
    return spark.createDataFrame(rows, "latitude int, longitude int, at string, uv_index int").select(
        F.col("latitude").cast("decimal(38,18)").alias("latitude"),
        F.col("longitude").cast("decimal(38,18)").alias("longitude"),
        F.col("at").cast("timestamp_ntz").alias("fetched_at"),
        F.col("uv_index").cast("decimal(38,18)").alias("uv_index"),
    )


def expected(i):
    if i % 3 == 1:
        return None
    place = 1 if i % 3 == 0 else i % 50
    return place + 2 if place < 40 else None


def as_dict(rows):
    got = {r["id"]: None if r["uv_index"] is None else int(r["uv_index"]) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("broadcast_rows", [lookup.BROADCAST_ROWS, 0])
def test_both_joins(spark, facts, uv, broadcast_rows):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup.uv_enrich(facts, uv, broadcast_rows=broadcast_rows, hot_rows=500)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (broadcast_rows > 0)
        assert ("SortMergeJoin" in plan) == (broadcast_rows == 0)
        assert as_dict(joined.collect()) == {i: expected(i) for i in range(9000)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_identical_rows_are_spread(spark):
    """Copies of one row, from several input partitions, get several salts."""
    copies = spark.range(4000).repartition(8).select(F.lit(1).alias("k"))
    salts = copies.select(lookup.spread(["k"], F.lit(32)).alias("s")).groupBy("s").count().collect()
    assert len(salts) > 3


def test_coverage_counts_zero(spark):
    rows = spark.createDataFrame([("A",), ("A",), ("Z",), (None,)], "city string")
    got = {r["city"]: r["row_count"] for r in lookup.city_coverage(spark, rows, " A , B").collect()}
    assert got == {"A": 2, "B": 0}


def test_readings_are_hash_aggregated_and_fit(spark, uv):
    found = lookup.readings(uv)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    far = uv.withColumn("uv_index", F.lit("-1234.5").cast("decimal(38,18)"))
    assert {float(r["uv_index"]) for r in lookup.readings(far).collect()} == {-102.3}


def test_each_record_takes_its_own_cycle(spark):
    schema = "latitude decimal(38,18), longitude decimal(38,18), cycle string"
    records = spark.createDataFrame([(D(1), D(2), c) for c in ("a", "b", "c", None)], schema)
    rows = [(D(1), D(2), c, None, D(v)) for c, v in (("a", 1), ("b", 2), (None, 9))]
    uv = spark.createDataFrame(rows, schema + ", fetched_at timestamp_ntz, uv_index decimal(38,18)")
    got = {r["cycle"]: r["uv_index"] for r in lookup.uv_enrich(records, uv).collect()}
    assert {c: v and int(v) for c, v in got.items()} == {"a": 1, "b": 2, "c": None, None: 9}


def test_facts_of_a_large_join_are_worked_out_once(spark, facts, uv):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    joined = lookup.uv_enrich(facts.mapInArrow(counted, facts.schema), uv, broadcast_rows=0, hot_rows=500)
    assert as_dict(joined.collect()) == {i: expected(i) for i in range(9000)}
    assert seen.value == 9000
