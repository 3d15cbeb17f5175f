"""Readers for stored records."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyledger.operators import moments
from skyledger.operators.latest import latest_per_key
from skyledger.schemas import RECORD, TEXT, WIDE
from skyledger.shared import nothing

# Measures whose stored type has fewer digits than a response: what was read, where it
# is not what was stored.
SEEN = T.StructType([T.StructField(name, WIDE) for name in ("temperature", "wind_speed")])

# Bookkeeping columns kept next to the record in the Parquet table.
STORED = T.StructType(
    [
        *RECORD.fields,
        T.StructField("seen", SEEN),
        T.StructField("reasons", T.ArrayType(TEXT)),
        T.StructField("raw_record", TEXT),
        T.StructField("batch", TEXT),
        T.StructField("outcome", TEXT),
        T.StructField("recorded_on", T.DateType()),
    ]
)

VALID = "valid"
REJECTED = "rejected"
FAILED = "failed"

LEDGER = (
    "batch string, first_id bigint, reserved_to bigint, complete boolean, stored bigint,"
    " rejected bigint, failed bigint"
)


def ledger_path(root: str) -> str:
    return f"{root.rstrip('/')}.ledger"


def city_path(root: str) -> str:
    return f"{ledger_path(root)}/cities"


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch.  Kept beside the table, so the counts of a run do not touch
    the records."""
    path = f"{ledger_path(root)}/batches"
    nothing(spark, LEDGER).write.mode("ignore").json(path)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").json(path)


def read_all(spark: SparkSession, root: str) -> DataFrame:
    """Every stored row with its partition columns.  A batch is seen once its ledger
    entry is complete, so rows of an interrupted write are not."""
    # One short name per batch, and the table's own listing has a folder for each.
    complete = read_ledger(spark, root).filter("complete").select("batch").distinct()
    rows = spark.read.schema(STORED).parquet(root)
    return rows.join(complete, "batch", "left_semi").select(*STORED.fieldNames())


def read_cities(spark: SparkSession, root: str) -> DataFrame:
    """What each complete batch adds to each city: rows and moments of the measures of its
    accepted records.  Kept beside the table: sums over it read no record."""
    schema = f"{moments.schema('city string')}, batch string"
    nothing(spark, schema).write.mode("ignore").parquet(city_path(root))
    entries = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(city_path(root))
    complete = read_ledger(spark, root).filter("complete").select("batch").distinct()
    return entries.join(complete, "batch", "left_semi")


def stored_latest_per_city(
    spark: SparkSession, root: str, n: int, since: datetime.date | None = None
) -> DataFrame:
    """The newest ``n`` accepted records of every city.  Each task passes on ``n`` rows a
    city at most, so a city that holds most of the table is never sorted as a whole."""
    rows = read_all(spark, root).filter(F.col("outcome") == VALID)
    if since is not None:
        rows = rows.filter(F.col("recorded_on") >= F.lit(since))
    return latest_per_key(rows.select(*RECORD.fieldNames()), "city", n)


def read_batch(spark: SparkSession, root: str, batch: str) -> DataFrame:
    """The rows of one batch, from its own folder: other batches are not even listed."""
    folder = f"{root}/batch={batch}"
    return spark.read.schema(STORED).option("basePath", root).parquet(folder)


def read_valid(spark: SparkSession, root: str, batch: str | None = None) -> DataFrame:
    """Accepted records; a filter on city skips row groups."""
    rows = read_all(spark, root) if batch is None else read_batch(spark, root, batch)
    return rows.filter(F.col("outcome") == VALID).select(*RECORD.fieldNames())


def stored_latest(
    spark: SparkSession, root: str, city: str, n: int, since: datetime.date | None = None
) -> DataFrame:
    """The newest ``n`` accepted records of a city.  ``since`` leaves folders of earlier
    days unread; a city's rows lie together in a file, so most row groups are skipped."""
    rows = read_all(spark, root).filter((F.col("outcome") == VALID) & (F.col("city") == city))
    if since is not None:
        rows = rows.filter(F.col("recorded_on") >= F.lit(since))
    newest = rows.orderBy(F.col("recorded_at").desc_nulls_first(), F.col("id").desc()).limit(n)
    return newest.select(*RECORD.fieldNames())


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Rows that broke an integrity rule, or whose fetch or parse failed."""
    return read_all(spark, root).filter(F.col("outcome") != VALID)


def even_ranges(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str, parts: int
) -> list[str]:
    """Conditions that cut a table into parts of even size, however its ids lie.  The
    database numbers them in order, along its index, and tells the ends of the parts only."""

    def ask(query: str):
        return spark.read.format("jdbc").options(url=url, dbtable=f"({query}) asked", **properties).load()

    # Quoted, as the columns of a table that this package created are.
    name = f'"{column}"'
    rows = ask(f"SELECT COUNT({name}) AS n FROM {table}").first()[0]
    step = -(-int(rows) // parts)
    if step < 2:
        return []
    in_order = f"SELECT {name} AS v FROM {table} WHERE {name} IS NOT NULL ORDER BY {name}"
    numbered = f"SELECT v, ROW_NUMBER() OVER () AS place FROM ({in_order}) ordered"
    told = f"SELECT v FROM ({numbered}) numbered"
    ends = ask(f"{told} WHERE MOD(place, {step}) = 0 AND place < {int(rows)}")
    cuts = sorted({row[0] for row in ends.collect()})
    if not cuts:
        return []
    between = [f"{name} > {a} AND {name} <= {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{name} <= {cuts[0]} OR {name} IS NULL", *between, f"{name} > {cuts[-1]}"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_on: str | None = "id",
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
) -> DataFrame:
    """A database table in the record's column order, read over several connections that
    share the values of ``split_on`` in parts of even size, or between ``bounds`` in even
    steps if they are given.  Filters are pushed down."""
    # Types are set at the source: a cast on top would keep filters from the database.
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RECORD.fields)
    options = {"preferTimestampNTZ": "true", "customSchema": types, **properties}
    parts = []
    if split_on is not None and bounds is None:
        parts = even_ranges(spark, url, table, properties, split_on, partitions)
    elif split_on is not None:
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    if parts:
        table_rows = spark.read.jdbc(url, table, predicates=parts, properties=options)
    else:
        table_rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    present = {name.lower(): name for name in table_rows.columns}
    return table_rows.select(
        *(
            F.col(present[field.name]).alias(field.name)
            for field in RECORD.fields
            if field.name in present
        )
    )
