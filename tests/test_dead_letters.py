"""How a micro-batch that cannot be stored is taken apart."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.sinks.table import withdraw, write_batch
from skyledger.sources import stored
from skyledger.sources.cities import DEFAULT_CITIES
from skyledger.streaming.cycle import SOURCE, _Store, dead_letters, state_parts


def test_each_row_of_few_files_is_tried_once_more(spark, tmp_path):
    tried = []

    class Refusing(_Store):
        def put(self, rows, name):
            files = [r[0] for r in rows.select(SOURCE).collect()]
            tried.extend(files)
            if "f2" in files:
                raise ValueError("refused")

    rows = spark.range(8).select("id", F.concat(F.lit("f"), F.col("id") % 4).alias(SOURCE))
    root = str(tmp_path / "table")
    store = Refusing(root, None, DEFAULT_CITIES, None)
    store.put_apart(rows, "cycle-0000000000", ValueError("refused"))
    assert sorted(tried) == ["f0", "f0", "f1", "f1", "f2", "f2", "f3", "f3"]
    assert [r[SOURCE] for r in dead_letters(spark, root).collect()] == ["f2", "f2"]


def test_a_withdrawn_batch_takes_no_disk_and_can_come_again(spark, tmp_path):
    root = str(tmp_path / "table")
    records = spark.createDataFrame(
        [("London", 1.5, 40), ("Paris", 2.5, 50)], "city string, temperature double, humidity int"
    )
    for name in ("a", "b"):
        write_batch(records, root, name)
    withdraw(spark, root, "a")
    assert not list((tmp_path / "table" / "batch=a").rglob("*.parquet"))
    assert stored.read_all(spark, root).select("batch").distinct().collect() == [("b",)]
    first = write_batch(records, root, "a")
    assert (first.stored + first.errors, first.last_id) == (2, first.stored)
    assert stored.read_all(spark, root).count() == 4


def test_state_is_packed_unless_the_user_chose(spark):
    codec = "spark.sql.streaming.stateStore.compression.codec"
    before = spark.conf.get(codec)
    with state_parts(spark):
        assert spark.conf.get(codec) == "zstd"
    assert spark.conf.get(codec) == before
    spark.conf.set(codec, "snappy")
    with state_parts(spark):
        assert spark.conf.get(codec) == "snappy"
    spark.conf.unset(codec)
