from __future__ import annotations

import hashlib
import re

import pytest

from skyledger.llm.exact_dedup import DEEPEST, deduplicate, double_directory
from tests.llm.corpus import AWKWARD, frame


def expected(rows):
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), text in zip(rows, norm, strict=True):
        ids = [j for (j, _), other in zip(rows, norm, strict=True) if other == text]
        keep = min((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("key_bits", [64, 2])
def test_same_as_brute_force(spark, key_bits):
    found = deduplicate(frame(spark, AWKWARD), capacity=2, key_bits=key_bits).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == expected(AWKWARD)
    if key_bits == 2:
        assert max(r["chain"] for r in found) > 1


def test_empty(spark):
    assert deduplicate(frame(spark, AWKWARD).limit(0)).count() == 0


def test_directory_doubles_until_buckets_fit():
    full = 1 << DEEPEST
    depth, cells = double_directory({0: 5, 1: 5, full - 1: 3}, 6)
    assert depth == DEEPEST and len(cells) == full
    assert [load for _, load in cells[:2]] == [5, 5] and cells[0][0] != cells[1][0]
    assert len({b for b, _ in cells[full // 2 :]}) == 1
    assert double_directory({3: 9}, 100) == (0, [(0, 9)])
    assert max(load for _, load in double_directory({3: 99}, 10)[1]) == 99
