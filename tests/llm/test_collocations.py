from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from skyledger.llm import collocations as ops
from tests.llm.corpus import AWKWARD, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, threshold=10, best=2000):
    """rows of (lang, text) -> sorted result rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    found = {}
    for (lang, run), a in f.items():
        if len(run) < 2 or a < threshold:
            continue
        cuts = []
        for k in range(1, len(run)):
            l, r = f[lang, run[:k]], f[lang, run[k:]]
            cuts.append((1000000 * a * a // (l * r), k, l, r))
        longer = [
            b
            for (other, words), b in f.items()
            if other == lang and len(run) == 2 and len(words) == 3 and b >= threshold
            and run in (words[:2], words[1:])
        ]
        if any(100 * b >= 50 * a for b in longer):
            continue
        score, _, l, r = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(run).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, n[lang], -score)
        for lang, rows in found.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:best], 1)
    )


def told(found):
    return sorted(tuple(r) for r in found.collect())


def invented(seed, n):
    draw = random.Random(seed)
    words = ["the", "of", "New", "york", "City", "été", "a", "b", "c", "😀"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", ":", ""]
    return [
        (draw.choice(["en", "fr", None]), "".join(draw.choice(words) + draw.choice(gaps) for _ in range(60)))
        for _ in range(n)
    ]


@pytest.mark.parametrize("best", [2000, 7])
def test_same_as_brute_force(spark, monkeypatch, best):
    monkeypatch.setattr(ops, "STRETCH", 700)
    rows = [*invented(1, 120), *[("en", t) for _, t in AWKWARD], ("en", "hot pair " * 5000), ("", "x y " * 20)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert told(ops.collocations(docs, best=best)) == brute(rows, best=best)


def test_awkward_rows_and_other_columns(spark):
    docs = frame(spark, AWKWARD * 4)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert told(ops.collocations(docs)) == brute(rows)


def test_no_rows(spark):
    found = ops.collocations(spark.createDataFrame([], "lang string, text string"))
    assert found.collect() == [] and found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert ops.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_merged_summaries_keep_every_frequent_key(seed):
    draw = np.random.default_rng(seed)
    threshold = 10
    rows = np.minimum(draw.zipf(1.3, 20_000), 5000).astype(np.uint64)
    true = Counter(rows.tolist())
    summaries = [np.unique(part, return_counts=True) for part in np.array_split(rows, 13)]
    keys, counts, lost = ops.merge_summaries(iter(summaries), len(rows) // threshold + 1)
    assert len(keys) <= len(rows) // threshold + 1 and lost < threshold
    kept = dict(zip(keys.tolist(), counts.tolist(), strict=True))
    for key, n in true.items():
        assert n - lost <= kept.get(key, 0) <= n
    assert {k for k, n in true.items() if n >= threshold} <= {k for k, c in kept.items() if c + lost >= threshold}


def test_a_small_capacity_loses_little(spark):
    keys = np.arange(100, dtype=np.uint64)
    one = (keys, np.where(keys < 3, 50, 1).astype(np.int64))
    found, counts, lost = ops.merge_summaries([one] * 4, 5)
    assert set(found.tolist()) >= {0, 1, 2} and len(found) <= 5
    assert lost <= 4 * int(one[1].sum()) // 6


def test_products_beyond_64_bits(spark):
    a = 3_000_000_000_000
    row = spark.createDataFrame([(a, a + 1, a + 7)], "a long, l long, r long").select(ops._score().alias("score"))
    assert row.first()[0] == 1000000 * a * a // ((a + 1) * (a + 7))
