"""Append record batches to a Parquet table, bad rows set aside.

Layout: ``root/batch=<name>/outcome=valid|rejected|failed/recorded_on=<day>``, rows sorted
by city and time within a file.  A batch is staged first: its files are counted, a running
sum of their counts gives every accepted row a dense id, and a second pass, without a
shuffle, puts the rows in place.  A batch owns its folder and its range of ids: writing it
again (a retry, a replayed micro-batch) replaces its rows and keeps the range if they fit.
Ids are reserved in the ledger before a row is put in place, and a batch is read once its
ledger entry says it is complete.  The ledger also keeps what the batch adds to each city.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from skyledger.functions import casts
from skyledger.operators import moments, quality
from skyledger.operators.lookup import BROADCAST_ROWS
from skyledger.schemas import RECORD
from skyledger.shared import nothing, one_row, written
from skyledger.sinks.conform import conformed
from skyledger.sources.stored import (
    FAILED,
    LEDGER,
    REJECTED,
    SEEN,
    STORED,
    VALID,
    city_path,
    ledger_path,
    read_ledger,
)


@dataclass(frozen=True)
class BatchCounts:
    batch: str
    stored: int
    rejected: int
    failed: int
    last_id: int

    @property
    def errors(self) -> int:
        return self.rejected + self.failed


def prepare(records: DataFrame) -> DataFrame:
    """Conformed columns plus ``reasons``, ``raw_record`` and ``outcome``; no id yet."""
    columns = records.columns
    rules = quality.integrity_rules(columns)
    failure = F.coalesce(
        *(F.col(c) for c in ("fetch_error", "parse_error") if c in columns), F.lit(None).cast("string")
    )
    broken = quality.broken_rules(rules)
    source = records.withColumns({"_failure": failure, "_broken": broken})
    is_failed, is_broken = F.col("_failure").isNotNull(), F.col("_broken") != ""

    stored = conformed(columns)
    if "recorded_at" not in columns and "fetched_at" in columns:
        stored["recorded_at"] = F.col("fetched_at").cast(RECORD["recorded_at"].dataType)
    for name in ("recorded_at", "created_at", "updated_at"):
        stored[name] = F.coalesce(stored[name], casts.utc_now())
    stored["id"] = F.lit(None).cast(RECORD["id"].dataType)

    def differs(name: str) -> Column:
        wide = F.col(name).try_cast(SEEN[name].dataType)
        return F.when(~wide.eqNullSafe(stored[name].cast(SEEN[name].dataType)), wide)

    measured = [
        (differs(name) if name in columns else F.lit(None).cast(SEEN[name].dataType)).alias(name)
        for name in SEEN.fieldNames()
    ]
    return source.select(
        *(value.alias(name) for name, value in stored.items()),
        F.struct(*measured).alias("seen"),
        F.when(is_failed, F.array("_failure"))
        .otherwise(quality.split_reasons(F.col("_broken")))
        .alias("reasons"),
        F.when(is_failed | is_broken, F.to_json(F.struct(*columns))).alias("raw_record"),
        F.when(is_failed, FAILED).when(is_broken, REJECTED).otherwise(VALID).alias("outcome"),
    )


def ensure_table(spark: SparkSession, root: str) -> None:
    """Create the table with its schema when there is none; readers then see no rows."""
    nothing(spark, STORED).write.mode("ignore").partitionBy("batch", "outcome", "recorded_on").parquet(root)


def _head(spark: SparkSession, root: str) -> int:
    """The first id no batch holds.  Kept in a file of its own: finding it costs the same
    after a million batches.  Lost in a crash, it is made anew from the entries."""
    try:
        found = spark.read.schema("next_id bigint").json(f"{ledger_path(root)}/head").first()
    except AnalysisException:
        found = None
    if found is not None:
        return found["next_id"]
    held = read_ledger(spark, root).agg(F.max("reserved_to")).first()[0]
    return (held or 0) + 1


def _set_head(spark: SparkSession, root: str, next_id: int) -> None:
    _put(spark, (next_id,), "next_id bigint", f"{ledger_path(root)}/head")


def _put(spark: SparkSession, row: tuple, schema: str, path: str) -> None:
    one_row(spark, schema, row).write.mode("overwrite").json(path)


def _entry(spark: SparkSession, root: str, batch: str):
    try:
        return spark.read.schema(LEDGER).json(f"{ledger_path(root)}/batches/{batch}").first()
    except AnalysisException:
        return None


def reserve(spark: SparkSession, root: str, batch: str, rows: int) -> tuple[int, int]:
    """First and last id of a batch's range: the one it has had before if its rows fit, or a
    new one.  The head moves first, so a crash in between wastes a range and never gives it
    twice."""
    held = _entry(spark, root, batch)
    if held is not None and held["reserved_to"] - held["first_id"] + 1 >= rows:
        first, last = held["first_id"], held["reserved_to"]
    else:
        first = _head(spark, root)
        last = first + rows - 1
        _set_head(spark, root, last + 1)
    _put_entry(spark, root, (batch, first, last, False, None, None, None))
    return first, last


def _put_entry(spark: SparkSession, root: str, entry: tuple) -> None:
    _put(spark, entry, LEDGER, f"{ledger_path(root)}/batches/{entry[0]}")


def withdraw(spark: SparkSession, root: str, batch: str) -> None:
    """Hide a batch and free its folder; its ids stay its own, so that it can be written again."""
    held = _entry(spark, root, batch)
    if held is not None and held["complete"]:
        _put_entry(spark, root, (batch, held["first_id"], held["reserved_to"], False, None, None, None))
        none = nothing(spark, STORED).drop("batch").write.mode("overwrite")
        none.partitionBy("outcome", "recorded_on").parquet(f"{root}/batch={batch}")


def _numbered(placed: DataFrame, shifts: DataFrame, first: int, files: int) -> DataFrame:
    """Staged rows with their ids.  The first id comes with the few rows of ``shifts``: as a
    literal beside the records it would be part of the code that Spark generates for them, and
    each batch would run code of its own that the JVM has not compiled yet."""
    shifts = shifts.withColumn("_shift", F.col("_shift") + F.lit(first).cast("bigint"))
    shifts = F.broadcast(shifts) if files <= BROADCAST_ROWS else shifts
    number = F.when(F.col("outcome") == VALID, F.col("_row") + F.col("_shift"))
    return placed.join(shifts, "_file").withColumn("id", number).drop("_file", "_row", "_shift")


def write_batch(
    records: DataFrame, root: str, batch: str | None = None, keep_empty: bool = True
) -> BatchCounts:
    """Write one batch and return its counts.

    ``records`` are worked out once.  One writer at a time per table.  Rows are dealt out by
    outcome and day into files of even size, a day with many rows into several.  Without
    ``keep_empty`` a batch of no rows leaves no trace.
    """
    spark = records.sparkSession
    batch = batch or uuid.uuid4().hex
    slot = hashlib.md5(root.encode()).hexdigest()[:12]
    day = F.coalesce(F.to_date("recorded_at"), F.lit("1970-01-01").cast("date"))
    rows = prepare(records).withColumn("recorded_on", day).hint("rebalance", "outcome", "recorded_on")
    in_order = ("outcome", "recorded_on", "city", "recorded_at")
    staged = written(rows.sortWithinPartitions(*in_order), "staged", slot)

    placed = staged.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counted = placed.groupBy("_file").agg(
        *(F.count_if(F.col("outcome") == name).alias(name) for name in (VALID, REJECTED, FAILED))
    )
    # One row per staged file.  Accepted rows are a file's last ones, so a row's number in
    # its file, less the others and with what comes before the file, is its number in all.
    before = Window.partitionBy().orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum(VALID).over(before), F.lit(0)) - F.col(REJECTED) - F.col(FAILED)
    totals = (F.coalesce(F.sum(name), F.lit(0)) for name in (VALID, REJECTED, FAILED))
    stored, rejected, failed, files = counted.agg(*totals, F.count(F.lit(1))).first()
    if not (keep_empty or stored or rejected or failed):
        return BatchCounts(batch, 0, 0, 0, 0)

    first, last = reserve(spark, root, batch, stored)
    numbered = _numbered(placed, counted.select("_file", shift.alias("_shift")), first, files)
    numbered.sortWithinPartitions(*in_order).write.mode("overwrite").partitionBy(
        "outcome", "recorded_on"
    ).parquet(f"{root}/batch={batch}")
    accepted = staged.filter(F.col("outcome") == VALID)
    moments.of(accepted, "city").withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(
        f"{city_path(root)}/{batch}"
    )
    _put_entry(spark, root, (batch, first, last, True, stored, rejected, failed))
    return BatchCounts(batch, stored, rejected, failed, first + stored - 1)


def run_counts(spark: SparkSession, root: str) -> DataFrame:
    """Successes and errors per batch."""
    return read_ledger(spark, root).filter("complete").select(
        "batch", "stored", (F.col("rejected") + F.col("failed")).alias("errors")
    )
