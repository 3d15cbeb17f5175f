"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm.bpe import digest_bpe
from skyledger.llm.collocations import collocations
from skyledger.llm.common import documents
from skyledger.llm.conversations import damage, repair
from skyledger.llm.exact_dedup import deduplicate
from skyledger.llm.fertility import judge_texts
from skyledger.llm.ngram_join import join_ngrams
from skyledger.llm.packing import pack
from skyledger.llm.pfor import digest_ids
from skyledger.llm.pii import digest_pii
from skyledger.llm.repeats import remove_repeats
from skyledger.llm.secrets import digest_secrets
from skyledger.llm.toxicity import score_toxicity
from skyledger.llm.token_counts import histogram, token_lengths

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays."""
    return deduplicate(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return digest_pii(documents(spark, sf_dir))


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return digest_secrets(documents(spark, sf_dir))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of encoded lengths with suffix sums."""
    return histogram(token_lengths(documents(spark, sf_dir)))


@query
def op6_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    return judge_texts(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "chars_per_token", "fallback_share", "entropy",
    )


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to, as digests."""
    return digest_bpe(documents(spark, sf_dir))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by its nearest labelled examples."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_toxicity(documents(spark, sf_dir), labels)


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack(documents(spark, sf_dir))


@query
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return join_ngrams(documents(spark, sf_dir))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 400-byte strings that occur more than once."""
    return remove_repeats(documents(spark, sf_dir)).drop("kept")


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of each language."""
    return collocations(documents(spark, sf_dir))


@query
def op12_pfor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to packed files and read back."""
    return digest_ids(documents(spark, sf_dir))


@query
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule, with its cheapest repair."""
    return repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
