"""Exact length histogram: how many documents have each encoded length, with suffix sums.

From the histogram alone every context limit is answered: documents and tokens at or
beyond it, the total after truncation, quantiles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import texts
from skyledger.llm.tokens import RANKS, encode
from skyledger.shared import written

#: Lengths of one block are summed by one task; blocks are summed after that.
BLOCK = 64


def token_lengths(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id and encoded length of every whole text; null and empty texts have length 0."""

    def lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [len(encode(text.as_py(), ranks)) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"]
            )

    return texts(docs).mapInArrow(lengths, "doc_id long, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """One row per length that occurs, with suffix sums over the lengths from it on.

    n_tokens, n_docs, docs_from and tokens_from (documents of at least this length and
    their tokens), truncated_tokens (all tokens if every document is cut to this length)
    and share_upto (share of documents of at most this length, so the q-quantile is the
    least length with share_upto >= q).  Repeated rows count each; no rows give no rows.
    """
    # Written, as two branches read it: texts are encoded once.
    counts = written(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "length-counts")
    counts = counts.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    tokens = F.col("n_docs") * F.col("n_tokens")
    # One row per BLOCK lengths: as many as the longest text has blocks, not documents.
    blocks = counts.groupBy("block").agg(
        F.sum("n_docs").alias("block_docs"), F.sum(tokens).alias("block_tokens")
    )
    later = Window.partitionBy().orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("block_docs").over(whole).alias("all_docs"),
        F.sum("block_tokens").over(whole).alias("all_tokens"),
    )
    within = (
        Window.partitionBy("block")
        .orderBy(F.desc("n_tokens"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    docs_from = F.sum("n_docs").over(within) + F.col("later_docs")
    tokens_from = F.sum(tokens).over(within) + F.col("later_tokens")
    return counts.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        docs_from.alias("docs_from"),
        tokens_from.alias("tokens_from"),
        (F.col("all_tokens") - tokens_from + docs_from * F.col("n_tokens")).alias(
            "truncated_tokens"
        ),
        ((F.col("all_docs") - docs_from + F.col("n_docs")) / F.col("all_docs")).alias("share_upto"),
    )


def truncated_total(lengths: DataFrame, limit: int) -> DataFrame:
    """One row: documents, tokens, tokens after cutting every document to ``limit``."""
    rows = histogram(lengths)
    cut = F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs"))
    return rows.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
        F.coalesce(F.sum(F.col("n_docs") * F.col("n_tokens")), F.lit(0)).alias("tokens"),
        F.coalesce(cut, F.lit(0)).alias("truncated_tokens"),
    )


def quantile(lengths: DataFrame, share: float) -> DataFrame:
    """One row: the least length that at least this share of the documents does not exceed."""
    return histogram(lengths).filter(F.col("share_upto") >= share).agg(
        F.min("n_tokens").alias("n_tokens")
    )
