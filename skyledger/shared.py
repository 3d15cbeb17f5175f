"""Intermediate tables in the folder the cluster names, and scoped settings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SETTING = "spark.checkpoint.dir"


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by the session.  A local one stands in only on
    a local master, as in tests: on a cluster each machine would write its own."""
    folder = spark.conf.get(SETTING, None)
    if folder is not None:
        return folder
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own:
        _own[application] = tempfile.mkdtemp(prefix="skyledger-")
    return _own[application]


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; no two calls share one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def nothing(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows of a schema, made without a Python worker."""
    return one_row(spark, schema).limit(0)


def one_row(spark: SparkSession, schema: T.StructType | str, row: tuple | None = None) -> DataFrame:
    """A row of plain values (NULL by default), made without a Python worker."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    values = row or (None,) * len(fields)
    cells = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, fields, strict=True)]
    return spark.range(0, 1, 1, 1).select(*cells)


def written(rows: DataFrame, name: str, slot: str | None = None) -> DataFrame:
    """Write once, read back.  Later use neither recomputes the rows nor depends
    on an executor that held them, and the scan knows its exact size.  A ``slot`` is
    overwritten by the next table of the same name: repeated jobs leave one folder."""
    spark = rows.sparkSession
    path = scratch_table(spark, name) if slot is None else f"{shared_folder(spark)}/{name}-{slot}"
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str, default: str) -> Iterator[None]:
    """Change a session setting for one action, unless the user changed it."""
    before = spark.conf.get(name, default)
    if before == default:
        spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


# The JVM does not compile methods above 8000 bytes of bytecode.  A projection
# of forty rule columns exceeds that as one generated method and then runs
# interpreted; below this limit Spark generates it in smaller pieces instead.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
METHOD_LIMIT_DEFAULT = "65535"
COMPILED_SIZE = "8000"


def compiled_projections(spark: SparkSession):
    """Keep wide projections within what the JVM compiles during an action, unless the
    user chose a limit."""
    return setting(spark, METHOD_LIMIT, COMPILED_SIZE, METHOD_LIMIT_DEFAULT)


def prefer_compiled(spark: SparkSession) -> None:
    """Keep wide projections within what the JVM compiles, unless the user chose."""
    if spark.conf.get(METHOD_LIMIT, METHOD_LIMIT_DEFAULT) == METHOD_LIMIT_DEFAULT:
        spark.conf.set(METHOD_LIMIT, COMPILED_SIZE)
