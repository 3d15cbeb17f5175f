"""What the text operators share: the columns they read, and Arrow buffers as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, return.
BLANKS = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Id and whole text of every row; a null text is empty, other columns are left."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def wrapped(docs: DataFrame, **keys: Column) -> DataFrame:
    """Rows as a struct ``row``, so that no column's name can clash, with keys beside it."""
    return docs.select(F.struct("*").alias("row"), *(key.alias(name) for name, key in keys.items()))


def one_of_each(rows: DataFrame, stay: DataFrame, *keys: str) -> DataFrame:
    """Exactly one of the wrapped rows of each key that ``stay`` names, unwrapped.  Rows of
    one key are repeated rows; the join has brought them together already."""
    same = F.lit(True)
    for key in keys:
        same = same & rows[key].eqNullSafe(stay[key])
    kept = rows.join(stay.hint("merge"), same, "left_semi")
    return kept.dropDuplicates(list(keys)).select("row.*")


def tasks(spark: SparkSession) -> int:
    """How many tasks a shuffle gets here."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and where each value starts (and the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)
    starts = starts[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[starts[0] : starts[-1]], starts - starts[0]


def pieces(batch: pa.RecordBatch, most: int = 2 << 20):
    """Slices of a batch whose texts hold about ``most`` bytes, so that what is
    worked out per byte stays bounded whatever the batch; one text is never cut."""
    _, starts = utf8(batch.column("text"))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(starts, starts[first] + most, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last
