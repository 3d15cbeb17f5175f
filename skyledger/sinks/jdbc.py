"""Append accepted records to a database table over JDBC."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyledger.schemas import RANGES, RECORD, TEXT_LIMITS
from skyledger.sinks.conform import conform

TEXT_DEFAULT = 200
#: Columns the table does without a value for: set by the database.
NOW = ("recorded_at", "created_at", "updated_at")
REQUIRED = ("city",)
#: Columns that reads of the table filter on.
INDEXED = ("city", "country", "recorded_at", "api_timestamp")

_TYPES = {"long": "BIGINT", "integer": "INTEGER", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def _text_type(name: str) -> str:
    return f"VARCHAR({TEXT_LIMITS.get(name, TEXT_DEFAULT)})"


def _sql_type(field: T.StructField) -> str:
    if isinstance(field.dataType, T.StringType):
        return _text_type(field.name)
    if isinstance(field.dataType, T.DecimalType):
        return f"DECIMAL({field.dataType.precision},{field.dataType.scale})"
    return _TYPES[field.dataType.typeName()]


def column_types(schema: T.StructType = RECORD) -> str:
    """Sized text columns for table creation; other types follow the schema."""
    return ", ".join(
        f"{field.name} {_text_type(field.name)}"
        for field in schema.fields
        if isinstance(field.dataType, T.StringType)
    )


def table_ddl(table: str, schema: T.StructType = RECORD) -> str:
    """The table with its key, required columns, checks and defaults."""
    columns = []
    for field in schema.fields:
        column = [f'"{field.name}"', _sql_type(field)]
        if field.name in NOW:
            column.append("DEFAULT CURRENT_TIMESTAMP")
        if field.name == "id" or field.name in REQUIRED:
            column.append("NOT NULL")
        if field.name == "id":
            column.append("PRIMARY KEY")
        if field.name in RANGES:
            low, high = RANGES[field.name]
            column.append(f'CHECK ("{field.name}" BETWEEN {low} AND {high})')
        columns.append(" ".join(column))
    return f"CREATE TABLE {table} ({', '.join(columns)})"


def index_ddl(table: str) -> list[str]:
    name = re.sub(r"\W", "_", table)
    return [f'CREATE INDEX idx_{name}_{column} ON {table} ("{column}")' for column in INDEXED]


def run_statement(spark: SparkSession, url: str, properties: dict[str, str], statement: str) -> None:
    """Run one statement in a database session of its own.

    Spark runs it when it opens the session for a read, here of a single row, so it needs no
    other driver than the tables do.  A task that is rerun runs it again: give statements
    that do nothing the second time, or whose second run fails."""
    one = spark.read.format("jdbc").options(url=url, dbtable="(VALUES (1)) AS one (n)", **properties)
    one.option("sessionInitStatement", statement).load().collect()


def exists(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> bool:
    try:
        spark.read.format("jdbc").options(url=url, dbtable=table, **properties).load()
    except (PySparkException, Exception) as error:  # noqa: B014 - drivers raise what they like
        if re.search(r"not exist|no such table|not found|unknown table", str(error), re.IGNORECASE):
            return False
        raise
    return True


def ensure_table(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> None:
    """Create the table, its constraints and indexes if it is absent."""
    if not exists(spark, url, table, properties):
        for statement in (table_ddl(table), *index_ddl(table)):
            run_statement(spark, url, properties, statement)


def append(
    valid: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    batch: str = "batch",
    connections: int = 8,
    batch_size: int = 10_000,
) -> None:
    """Append all records in one transaction; create the table if absent.

    Tasks fill a staging table of the batch, ``connections`` at a time; one that is rerun
    after its commit repeats its rows there.  One statement then takes over the distinct
    rows whose id the table does not hold, all or none: a batch that is sent again, in part
    or as a whole, adds nothing.
    """
    spark = valid.sparkSession
    ensure_table(spark, url, table, properties)
    staging = staging_name(table, batch)
    stage(valid, url, staging, properties, connections, batch_size)
    take_over(spark, url, table, staging, properties)
    run_statement(spark, url, properties, f"DROP TABLE {staging}")


def staging_name(table: str, batch: str) -> str:
    return f"{table}_in_{re.sub(r'[^A-Za-z0-9]', '_', batch)}"


def stage(
    valid: DataFrame,
    url: str,
    staging: str,
    properties: dict[str, str],
    connections: int = 8,
    batch_size: int = 10_000,
    mode: str = "overwrite",
) -> None:
    """Fill the staging table of a batch anew."""
    (
        # Writers are few; the stages before them keep their own number of tasks.
        conform(valid)
        .repartition(connections)
        .write.format("jdbc")
        .options(url=url, dbtable=staging, **properties)
        .option("createTableColumnTypes", column_types())
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
        .mode(mode)
        .save()
    )


def take_over(
    spark: SparkSession, url: str, table: str, staging: str, properties: dict[str, str]
) -> None:
    """Rows of the staging table that the table does not hold, in one statement.  Times that
    are missing are set now."""
    names = ", ".join(f'"{name}"' for name in RECORD.fieldNames())
    values = ", ".join(
        f'COALESCE(s."{name}", CURRENT_TIMESTAMP)' if name in NOW else f's."{name}"'
        for name in RECORD.fieldNames()
    )
    run_statement(
        spark, url, properties,
        f"INSERT INTO {table} ({names}) SELECT DISTINCT {values} FROM {staging} s"
        f' WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE t."id" = s."id")',
    )


def newest(rows: DataFrame, city: str, n: int) -> DataFrame:
    """City filter runs in the database; Spark keeps the newest ``n``."""
    return (
        rows.filter(F.col("city") == city)
        .orderBy(F.col("recorded_at").desc_nulls_first(), F.col("id").desc())
        .limit(n)
    )
