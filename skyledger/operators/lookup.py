"""Lookups by key: UV by coordinates, coverage of the configured cities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger.operators.parse import COORDINATE_KEY
from skyledger.shared import written
from skyledger.sources.cities import city_dimension, names

# Rows of three fixed-width values and a cycle name take under 200 bytes each, so this
# is under 100 MB.
BROADCAST_ROWS = 500_000
# A key with more facts than this is shared by several tasks, each with about so many.
HOT_ROWS = 1_000_000

KEY = ("_lat", "_lon", "_cycle")

# A reading is packed in one long, so that the latest one is a maximum of a number: its
# time in microseconds, then its value in tenths.  Values beyond the stored type's range
# (-99.9 to 99.9) become the nearest ones outside of it.
_TENTHS = 2048
_FARTHEST = 102.3


def fits_broadcast(lookup: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return lookup.count() <= rows


def spread(columns: Sequence[str], salts: Column) -> Column:
    """A salt per row.  Hashing the row with its partition number spreads a hot
    key, and also a crowd of identical rows, and repeats when a task is rerun."""
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), salts).cast("int")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left join to a lookup with one fixed-width row per key.

    A lookup of checked size is broadcast, so the facts do not move.  Beyond that the facts
    are written first, since they are looked at twice: a count finds the keys that hold more
    than ``hot_rows`` of them, and those are joined on key and salt, with as many salts as
    their facts need.  Facts with a NULL in the key match nothing and are dealt out evenly.
    ``spread_by`` names columns that tell rows apart; by default all.
    """
    on = list(on)
    if fits_broadcast(lookup, broadcast_rows):
        return facts.join(F.broadcast(lookup), on, "left")
    spark = facts.sparkSession
    facts = written(facts, "facts")
    keyed = F.lit(True)
    for name in on:
        keyed = keyed & F.col(name).isNotNull()
    counted = facts.filter(keyed).groupBy(*on).count().filter(F.col("count") > hot_rows)
    salts = F.ceil(F.col("count") / hot_rows).cast("int").alias("_salts")
    # Fewer keys than facts / hot_rows can be hot; they are few, and their number is checked.
    hot = written(counted.select(*on, salts), "hot-keys")
    if fits_broadcast(hot, broadcast_rows):
        hot = F.broadcast(hot)
    nowhere = F.lit(int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = F.when(keyed, F.coalesce("_salts", F.lit(1))).otherwise(nowhere)
    salted = facts.join(hot, on, "left")
    salted = salted.withColumn("_salt", spread(spread_by or facts.columns, parts)).drop("_salts")
    copies = lookup.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    return salted.join(copies.drop("_salts").hint("merge"), [*on, "_salt"], "left").drop("_salt")


def _tenths() -> Column:
    near = F.greatest(F.least(F.col("uv_index"), F.lit(_FARTHEST)), F.lit(-_FARTHEST))
    return F.round(near.cast("decimal(10,4)") * 10, 0)


def reading_rows(uv: DataFrame, *more: Column) -> DataFrame:
    """Key and value of every reading that has both."""
    value = (_tenths() / F.lit(10)).cast("decimal(5,1)").alias("uv_index")
    kept = uv.filter(F.col("uv_index").isNotNull())
    return kept.select(*key_columns(uv.columns), value, *more).filter(_complete())


def readings(uv: DataFrame) -> DataFrame:
    """One row per place and cycle: the last reading, ties to the higher value."""
    tenths = _tenths().cast("long") + _TENTHS // 2
    start = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', fetched_at)"
    at = F.coalesce(F.expr(start), F.lit(0))
    kept = uv.filter(F.col("uv_index").isNotNull())
    keyed = kept.select(*key_columns(uv.columns), (at * _TENTHS + tenths).alias("_packed"))
    last = keyed.filter(_complete()).groupBy(*KEY).agg(F.max("_packed").alias("_packed"))
    value = (F.pmod("_packed", F.lit(_TENTHS)) - _TENTHS // 2).cast("decimal(5,0)") / F.lit(10)
    return last.select(*KEY, value.cast("decimal(5,1)").alias("uv_index"))


def key_columns(columns: Sequence[str]) -> list[Column]:
    """Place to six decimals, and the cycle; input without cycles is one cycle."""
    cycle = F.coalesce("cycle", F.lit("")) if "cycle" in columns else F.lit("")
    return [
        F.col("latitude").try_cast(COORDINATE_KEY).alias("_lat"),
        F.col("longitude").try_cast(COORDINATE_KEY).alias("_lon"),
        cycle.alias("_cycle"),
    ]


def _complete() -> Column:
    return F.col("_lat").isNotNull() & F.col("_lon").isNotNull()


def join_uv(records: DataFrame, lookup: DataFrame, **join_options) -> DataFrame:
    """Add ``uv_index`` from a lookup made by :func:`readings`."""
    keyed = records.drop("uv_index").select("*", *key_columns(records.columns))
    return lookup_join(keyed, lookup, KEY, **join_options).drop(*KEY)


def uv_enrich(records: DataFrame, uv: DataFrame, **join_options) -> DataFrame:
    """Add ``uv_index``: the reading of the record's place in the record's own cycle.
    Records without a match keep NULL.

    The lookup is written first: its size is then known without reading the UV
    responses twice.
    """
    return join_uv(records, written(readings(uv), "uv"), **join_options)


def city_coverage(
    spark: SparkSession, records: DataFrame, cities: str, weight: Column | None = None
) -> DataFrame:
    """Rows stored per configured city, zero included.  A row counts ``weight`` times.

    The IN filter reaches the scan, so the counts have at most one row per
    configured city and are safe to broadcast.
    """
    counts = (
        records.filter(F.col("city").isin(names(cities)))
        .groupBy("city")
        .agg(F.sum(F.lit(1) if weight is None else weight).alias("n"))
    )
    return (
        city_dimension(spark, cities)
        .join(F.broadcast(counts), "city", "left")
        .select("city", F.coalesce("n", F.lit(0)).alias("row_count"))
    )
