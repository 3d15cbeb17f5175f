from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyledger.llm.queries import QUERIES
from skyledger.llm.token_counts import histogram, quantile, token_lengths, truncated_total
from tests.llm.corpus import AWKWARD, frame

ROWS = [*AWKWARD, (200, "a <|endoftext|> b"), (201, "word " * 900), (202, "it's 12,5 €")]


@pytest.fixture(scope="module")
def exact():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in ROWS]


def test_histogram(spark, exact):
    found = histogram(token_lengths(frame(spark, ROWS))).collect()
    counts, n = Counter(exact), len(exact)
    assert {r["n_tokens"]: r["n_docs"] for r in found} == counts and len(found) == len(counts)
    for r in found:
        at = r["n_tokens"]
        assert r["docs_from"] == sum(x >= at for x in exact)
        assert r["tokens_from"] == sum(x for x in exact if x >= at)
        assert r["truncated_tokens"] == sum(min(x, at) for x in exact)
        assert r["share_upto"] == pytest.approx(sum(x <= at for x in exact) / n)


def test_any_limit(spark, exact):
    lengths = token_lengths(frame(spark, ROWS))
    assert tuple(truncated_total(lengths, 777).first()) == (
        len(exact), sum(exact), sum(min(x, 777) for x in exact)
    )
    assert quantile(lengths, 0.5).first()[0] == sorted(exact)[(len(exact) - 1) // 2]


def test_empty(spark):
    none = token_lengths(frame(spark, ROWS).limit(0))
    assert histogram(none).count() == 0
    assert tuple(truncated_total(none, 5).first()) == (0, 0, 0)


def test_query_has_whole_table(spark):
    rows = QUERIES["op9_token_counts"](spark, "/root/testdata/sf0.001").collect()
    assert sum(r["n_docs"] for r in rows) == spark.read.parquet(
        "/root/testdata/sf0.001/documents.parquet"
    ).count()
