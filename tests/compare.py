"""Run queries against their oracles in DuckDB.

``python tests/compare.py [sf_dir] [name…]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import math
import sys
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def cell(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def differences(spark, connection, sf_dir: str, name: str) -> str | None:
    """NULL when both engines agree, else what differs."""
    result = queries()[name](spark, sf_dir)
    mine = bag(result.columns, result.collect())
    cursor = connection.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    theirs = bag(columns, cursor.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(columns)}"
    if not mine:
        return "no rows"
    if mine != theirs:
        extra, missing = mine - theirs, theirs - mine
        return (
            f"{sum(mine.values())} against {sum(theirs.values())} rows; "
            f"only Spark: {list(extra)[:2]}; only SQL: {list(missing)[:2]}"
        )
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    engine = duck(folder)
    failed = 0
    for name in wanted:
        try:
            problem = differences(session, engine, folder, name) if name in oracle_sql() else "no oracle"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"error {str(error)[:600]}"
        failed += problem is not None
        print(f"{name}: {problem or 'same'}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} same")
