"""Repeated fetch cycles as a stream.

A record takes the UV reading of its own place and cycle, and the two may come in different
micro-batches.  Both are parsed in the stream and meet in a stream-stream left outer join;
what waits is in Spark's own state store, for ``lateness``, then the record goes on without
a reading.  The rows do not depend on how files fall into micro-batches, as long as a cycle
asks each place once; of several readings one of the first micro-batch with any counts.

Time is when a response is first seen.  Spark keeps that time with a micro-batch, so a replay
sees the same one, and no response can come too late for the state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators import lookup
from skyledger.plans.jobs import RunResult, record_rows, store_joined, uv_rows
from skyledger.schemas import LANDING
from skyledger.shared import nothing, one_row, setting, written
from skyledger.sinks.table import withdraw
from skyledger.sources import landing as land
from skyledger.sources.cities import DEFAULT_CITIES
from skyledger.sources.stored import read_ledger

DEFAULT_INTERVAL = 60  # seconds between cycles
LATENESS = timedelta(days=1)
#: A clock set back by less than this loses nothing.
CLOCK = "10 minutes"
#: A cycle that cannot be stored is tried so many times before it is taken apart.
ATTEMPTS = 3
#: So many parts it is taken apart into, at most ten: a part's name ends in its digit.
PARTS = 8

SOURCE = "source_file"
_SEEN, _READ, _WAITS = "_seen", "_read", "_waits"
_END_OF_TIME = "9999-01-01 00:00:00"

# The later of both sides' watermarks counts: time is that of the micro-batch on both.
_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"

#: Parts of a stream's state per core: each part of each store is a file of its own in every
#: micro-batch, so more of them cost time and gain nothing.
STATE_PARTS = 2
_PARTITIONS = "spark.sql.shuffle.partitions"
#: How the files of a state are packed: what waits is whole rows, most of the disk of a checkpoint.
_CODEC, _CODEC_DEFAULT, PACKED = "spark.sql.streaming.stateStore.compression.codec", "lz4", "zstd"
_ADAPTIVE = "spark.sql.adaptive.enabled"


def batch_name(stream: str, number: int) -> str:
    return f"{stream}-{number:010d}"


def ends(spark: SparkSession, checkpoint: str) -> DataFrame:
    """A stream of marks that end a stream: at most one, written by :func:`end_stream`."""
    path = _ends_path(checkpoint)
    nothing(spark, "at string").write.mode("ignore").json(path)
    return spark.readStream.schema("at string").json(path)


def _ends_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}.end"


def end_stream(spark: SparkSession, checkpoint: str) -> None:
    """Leave a mark that moves the watermark past everything that still waits."""
    one_row(spark, "at string", (_END_OF_TIME,)).write.mode("append").json(_ends_path(checkpoint))


def has_ended(spark: SparkSession, checkpoint: str) -> bool:
    try:
        return not spark.read.schema("at string").json(_ends_path(checkpoint)).isEmpty()
    except AnalysisException:
        return False


@contextmanager
def state_parts(spark: SparkSession) -> Iterator[None]:
    """Start a stream inside of this: its state has as many parts as the cores can use, if the
    session's shuffles have more, and is packed well, unless the user chose a codec.  A
    checkpoint keeps what it was begun with."""
    own = spark.conf.get(_PARTITIONS)
    fewer = min(int(own), STATE_PARTS * spark.sparkContext.defaultParallelism)
    with setting(spark, _PARTITIONS, str(fewer), own), setting(spark, _CODEC, PACKED, _CODEC_DEFAULT):
        yield


@contextmanager
def as_batch(spark: SparkSession, own: dict[str, str]) -> Iterator[None]:
    """Work of a micro-batch with the user's ``own`` settings.  Spark switches adaptive plans
    off in a stream's session, where it needs a fixed number of parts for its state; without
    them rows would not be dealt out by day, and each task would write a file for every day."""
    before = {name: spark.conf.get(name) for name in own}
    try:
        for name, value in own.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def with_readings(responses: DataFrame, marks: DataFrame, lateness: timedelta = LATENESS) -> DataFrame:
    """Records of a response stream with ``uv_index``, failures kept."""
    wait = f"INTERVAL '{int(lateness.total_seconds())}' SECOND"
    triaged = land.triage(responses.withColumn(_SEEN, F.current_timestamp()))
    readings = lookup.reading_rows(uv_rows(triaged), F.col(_SEEN).alias(_READ))
    nowhere = [F.lit(None).cast(f.dataType).alias(f.name) for f in readings.schema if f.name != _READ]
    mark = marks.select(*nowhere, F.to_timestamp("at").alias(_READ))
    readings = (
        readings.unionByName(mark)
        .withWatermark(_READ, f"{int(lateness.total_seconds())} seconds")
        .dropDuplicatesWithinWatermark(list(lookup.KEY))
    )
    readings = readings.toDF(*(f"r{c}" if c in lookup.KEY else c for c in readings.columns))
    records = record_rows(triaged)
    keyed = records.select("*", *lookup.key_columns(records.columns)).withWatermark(_SEEN, CLOCK)
    failed = F.col("fetch_error").isNotNull() | F.col("parse_error").isNotNull()
    keyed = keyed.withColumn(_WAITS, ~failed & F.col("_lat").isNotNull() & F.col("_lon").isNotNull())
    same: Column = F.lit(True)
    for name in lookup.KEY:
        same = same & (F.col(name) == F.col(f"r{name}"))
    # A row that waits for nothing fails the left side's own condition and goes on at once.
    in_time = F.expr(f"{_READ} <= {_SEEN} + {wait} AND {_SEEN} <= {_READ} + {wait}")
    joined = keyed.join(readings, F.col(_WAITS) & same & in_time, "left_outer")
    return joined.drop(*lookup.KEY, *(f"r{c}" for c in lookup.KEY), _READ, _SEEN, _WAITS)


@dataclass(frozen=True)
class _Store:
    """How the rows of a micro-batch are stored."""

    root: str
    profile: str | None
    cities: str
    database: Callable[[DataFrame], None] | None

    def put(self, rows: DataFrame, name: str) -> RunResult:
        rows = rows.drop(SOURCE)
        return store_joined(
            rows, self.root, name, self.profile, cities=self.cities, database=self.database, keep_empty=False
        )

    def put_apart(self, rows: DataFrame, name: str, error: Exception) -> None:
        """Store what can be stored, file by file; the rest are dead letters.

        The files are tried in ``PARTS`` parts, a part that fails likewise: each round stores
        again what failed in the one before, so there are to be few.  A micro-batch reads a
        bounded number of files, so their names are few."""
        withdraw(rows.sparkSession, self.root, name)
        files = sorted(r[0] or "" for r in rows.select(SOURCE).distinct().collect())
        if len(files) < 2:
            self._bury(rows, name, error)
            return
        each = -(-len(files) // PARTS)
        for k, start in enumerate(range(0, len(files), each)):
            part = files[start : start + each]
            some = rows.filter(F.coalesce(F.col(SOURCE), F.lit("")).isin(part))
            try:
                self.put(some, f"{name}-{k}")
            except Exception as again:  # noqa: BLE001 - whatever a sink raises
                self.put_apart(some, f"{name}-{k}", again)

    def _bury(self, rows: DataFrame, name: str, error: Exception) -> None:
        told = rows.select(
            F.lit(name).alias("batch"),
            F.lit(str(error)[:2000]).alias("error"),
            SOURCE,
            F.to_json(F.struct(*(c for c in rows.columns if c != SOURCE))).alias("raw_record"),
        )
        told.write.mode("overwrite").parquet(f"{_dead_path(self.root)}/{name}")


def _dead_path(root: str) -> str:
    return f"{root.rstrip('/')}.dead"


DEAD = "batch string, error string, source_file string, raw_record string"


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """Rows no attempt could store, with the error and the file they came from.  Those of a
    micro-batch that was stored after all, in a replay, are not."""
    path = _dead_path(root)
    nothing(spark, DEAD).write.mode("ignore").parquet(path)
    rows = spark.read.schema(DEAD).option("recursiveFileLookup", "true").parquet(path)
    complete = read_ledger(spark, root).filter("complete").select(F.col("batch").alias("_whole"))
    whole = F.regexp_extract("batch", r"^(.*-[0-9]{10})(-[0-9])*$", 1)
    return rows.join(complete, whole == F.col("_whole"), "left_anti")


def _parts(spark: SparkSession, root: str, name: str) -> list[str]:
    """Batches that an earlier attempt at a micro-batch left, taken apart."""
    rows = read_ledger(spark, root).filter(F.col("complete") & F.col("batch").startswith(f"{name}-"))
    return [r["batch"] for r in rows.select("batch").collect()]


def start_cycles(
    responses: DataFrame,
    root: str,
    checkpoint: str,
    stream: str = "cycle",
    interval: int | None = DEFAULT_INTERVAL,
    profile: str | None = "strict",
    cities: str = DEFAULT_CITIES,
    on_result: Callable[[RunResult], None] | None = None,
    lateness: timedelta = LATENESS,
    database: Callable[[DataFrame], None] | None = None,
    attempts: int = ATTEMPTS,
) -> StreamingQuery:
    """Store every micro-batch of a response stream as a batch of its own.

    ``interval=None`` handles all files not seen before and stops, the form for
    a scheduler.  Bad responses are stored as failed rows.  A micro-batch that cannot be
    stored in ``attempts`` is taken apart by file; the files that still cannot go to
    :func:`dead_letters`, and the stream goes on.  A micro-batch is named by its number, so
    a replay after a failure replaces its own output.  Reports passed to ``on_result``
    cover one micro-batch.
    """
    spark = responses.sparkSession
    if has_ended(spark, checkpoint):
        raise ValueError(f"the stream of {checkpoint} has been flushed: start with a new checkpoint")
    return _start(
        responses, _Store(root, profile, cities, database), checkpoint, stream, interval, on_result, lateness,
        attempts,
    )


def _start(
    responses: DataFrame,
    store: _Store,
    checkpoint: str,
    stream: str,
    interval: int | None,
    on_result: Callable[[RunResult], None] | None,
    lateness: timedelta,
    attempts: int,
) -> StreamingQuery:
    spark = responses.sparkSession
    slot = hashlib.md5(f"{store.root} {stream}".encode()).hexdigest()[:12]
    own = {name: spark.conf.get(name) for name in (_ADAPTIVE, _PARTITIONS)}
    first = True

    def one_cycle(micro_batch: DataFrame, number: int) -> None:
        with as_batch(micro_batch.sparkSession, own):
            store_cycle(micro_batch, number)

    def store_cycle(micro_batch: DataFrame, number: int) -> None:
        nonlocal first
        name = batch_name(stream, number)
        if first:
            # Only the first micro-batch of a run can be a replay.
            for part in _parts(spark, store.root, name):
                withdraw(spark, store.root, part)
            first = False
        rows = micro_batch
        for attempt in range(1, attempts + 1):
            try:
                result = store.put(rows, name)
                break
            except Exception as error:  # noqa: BLE001 - whatever a sink raises
                if attempt == 1:
                    # From here on the stream's own work is not done again.
                    rows = written(micro_batch, "cycle-rows", slot)
                if attempt == attempts:
                    store.put_apart(rows, name, error)
                    return
        if on_result is not None and result.counts is not None:
            on_result(result)

    if SOURCE not in responses.columns:
        responses = responses.withColumn(SOURCE, F.lit(None).cast("string"))
    responses = responses.select(*LANDING.fieldNames(), SOURCE)
    trigger = {"availableNow": True} if interval is None else {"processingTime": f"{interval} seconds"}
    with setting(spark, _POLICY, "max", "min"), state_parts(spark):
        return (
            with_readings(responses, ends(spark, checkpoint), lateness)
            .writeStream.queryName(stream)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .foreachBatch(one_cycle)
            .start()
        )


def flush(
    responses: DataFrame,
    root: str,
    checkpoint: str,
    stream: str = "cycle",
    profile: str | None = "strict",
    cities: str = DEFAULT_CITIES,
    on_result: Callable[[RunResult], None] | None = None,
    lateness: timedelta = LATENESS,
    database: Callable[[DataFrame], None] | None = None,
    attempts: int = ATTEMPTS,
) -> None:
    """End a stream: handle the files not seen before and store what still waits without a
    reading.  Its checkpoint takes no more responses after that."""
    spark = responses.sparkSession
    if not has_ended(spark, checkpoint):
        end_stream(spark, checkpoint)
    _start(
        responses, _Store(root, profile, cities, database), checkpoint, stream, None, on_result, lateness, attempts
    ).awaitTermination()


def run_supervised(start: Callable[[], StreamingQuery], restarts: int = 3) -> None:
    """Start cycles from their checkpoint again when the query itself fails, ``restarts``
    times in a row at most; a cycle that ends well sets the count back."""
    failures, done = 0, -1
    while True:
        query = start()
        try:
            query.awaitTermination()
            return
        except Exception:
            progress = query.lastProgress
            reached = -1 if progress is None else progress["batchId"]
            failures = 1 if reached > done else failures + 1
            done = max(done, reached)
            if failures > restarts:
                raise
