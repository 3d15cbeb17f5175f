from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from skyledger.llm import repeats
from skyledger.llm.bwt_merge import END, interleave, merged_suffixes, transformed
from tests.llm.corpus import AWKWARD, frame


def expected(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    times = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, int)
        for k in range(len(t) - length + 1):
            if times[t[k : k + length]] > 1:
                gone[k : k + length] = 1
        gone[-1] = 0
        left = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        runs = int((np.diff(gone, prepend=0) == 1).sum())
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    letters = lambda n, of="abcdefgh é": "".join(rng.choice(of) for _ in range(n))
    passages = [letters(n) for n in (380, 399, 400, 401, 450, 900, 2500)]
    rows = [(i, t) for i, t in AWKWARD if len(t or "") < 3000]
    for k in range(60):
        text = letters(rng.randrange(900))
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            if k % 3 == 0:
                cut = rng.randrange(len(p))
                p = p[:cut] + "#" + p[cut + 1 :]
            text += (p if k % 5 else p[rng.randrange(40) :]) + letters(rng.randrange(60))
        rows.append((100 + k, text))
    rows += [(300, "ab" * 700), (301, "x" * 405), (302, "x" * 404), (303, "y" * 400), (304, "z" * 401)]
    near = letters(1500)
    for k in range(25):
        cut = rng.randrange(1500)
        rows.append((400 + k, near[:cut] + letters(1) + near[cut + 1 :]))
    rows += [(450, near), (450, near), (None, passages[5] + "q"), (None, None)]
    return rows


def answer(spark, rows, **limits):
    found = repeats.remove_repeats(frame(spark, rows), **limits).drop("kept").collect()
    return sorted((tuple(r) for r in found), key=str)


def test_same_as_brute_force(spark, corpus):
    assert answer(spark, corpus) == expected(corpus, 400)


def test_hot_cores_window_by_window(spark, corpus, monkeypatch):
    monkeypatch.setattr(repeats, "MERGED", 0)
    assert answer(spark, corpus) == expected(corpus, 400)


def test_small_shards(spark, corpus, monkeypatch):
    monkeypatch.setattr(repeats, "STRETCH", 3000)
    assert answer(spark, corpus[:60]) == expected(corpus[:60], 400)


def test_kept_bytes(spark):
    rows = [(1, "a" * 10 + "b" * 500), (2, "b" * 450 + "é")]
    kept = {r["doc_id"]: r["kept"] for r in repeats.remove_repeats(frame(spark, rows)).collect()}
    assert kept == {1: b"a" * 10, 2: "é".encode()}


def test_interleave_sorts_and_measures_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(60):
        shards, depth = [], int(rng.integers(1, 9))
        for _ in range(int(rng.integers(1, 5))):
            strings = [rng.integers(1, 4, int(rng.integers(0, 12))) for _ in range(int(rng.integers(1, 6)))]
            shards.append(transformed(np.concatenate([np.append(s, END) for s in strings])))
        of, prefix = interleave(shards, depth)
        symbols = np.concatenate([s.symbols for s in shards])
        starts = merged_suffixes(shards, of)
        assert sorted(starts.tolist()) == list(range(len(symbols)))
        heads = []
        for at in starts.tolist():
            head = symbols[at : at + depth].tolist()
            end = head.index(END) if END in head else None
            heads.append(tuple(head) if end is None else (*head[:end], -1000 + at / len(symbols)))
        assert heads == sorted(heads)
        for k in range(1, len(heads)):
            same = [x == y for x, y in zip(heads[k - 1], heads[k], strict=False)]
            assert prefix[k] == (same.index(False) if False in same else len(same))


def test_empty(spark):
    assert repeats.remove_repeats(frame(spark, AWKWARD).limit(0)).count() == 0
