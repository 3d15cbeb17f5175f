from __future__ import annotations

import random
import re

import numpy as np
import pytest

from skyledger.llm import ngram_join as nj
from skyledger.llm.graph import components
from tests.llm.corpus import AWKWARD, frame


def shingles(text: str, n: int = 4) -> set:
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c < "\x80" else c for c in text))
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def expected(rows):
    sets = [shingles(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids, default=None)))
    return sorted(out, key=str)


def noisy(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng, rows = random.Random(11), list(AWKWARD)
    common = " ".join(f"shared{k}" for k in range(25))
    for g, size in enumerate((4, 7, 8, 9, 12, 20, 45, 150, 400)):
        base = [f"w{g}x{k}" for k in range(size)]
        for k in range(14):
            text = noisy(rng, base, rng.randrange(1 + size // 25 + (k % 3)))
            rows.append((1000 + 20 * g + k, text.upper() if k % 4 == 1 else text))
            if k % 5 == 0:
                rows.append((1000 + 20 * g + 14 + k // 5, f"{common} {text} {common}"))
    for k in range(40):
        rows.append((3000 + k, common + " " + " ".join(f"u{k}v{j}" for j in range(k))))
    rows += [(None, "w3x1 w3x2 w3x3 w3x4 w3x5 w3x6 w3x7 w3x8"), (None, "only here with a null id")]
    return rows


def answer(spark, rows):
    return sorted((tuple(r) for r in nj.join_ngrams(frame(spark, rows)).collect()), key=str)


def test_same_as_brute_force(spark, corpus):
    assert answer(spark, corpus) == expected(corpus)


def test_large_clusters(spark, corpus, monkeypatch):
    monkeypatch.setattr(nj, "TREE", 8)
    assert answer(spark, corpus) == expected(corpus)


def test_bound_and_tree():
    rng, rule = np.random.default_rng(4), nj.Rule(85)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = []
    for _ in range(120):
        keep = base[rng.random(300) > rng.random() * 0.2]
        sets.append(np.unique(np.append(keep, rng.integers(0, 2**63, 9).astype(np.uint64))))
    shared = lambda a, b: len(np.intersect1d(a, b))
    for a, b in zip(sets, sets[1:], strict=False):
        assert np.minimum(nj.counts(a), nj.counts(b)).sum() >= shared(a, b)
    tree = nj.CountTree(sets)
    for k in range(0, 120, 7):
        found = {tree.given(p) for p in tree.partners(sets[k], k, rule)}
        assert found == {
            j for j in range(120)
            if j != k and rule.links(shared(sets[k], sets[j]), len(sets[k]) + len(sets[j]))
        }


def test_linked_sets_share_a_group():
    rng, rule = np.random.default_rng(9), nj.Rule(85)
    for _ in range(400):
        n = int(rng.integers(7, 300))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        gone = int(rng.integers(0, max(1, rule.differing(2 * n)) + 1))
        b = np.unique(np.append(a[gone:], rng.integers(0, 2**63, gone // 3).astype(np.uint64)))
        if rule.links(len(np.intersect1d(a, b)), len(a) + len(b)) and len(a) != len(b):
            common = np.sort(rng.choice(a, len(a) // 2, replace=False))
            for held in (common, common[:0]):
                told = [nj.group_hashes(x, rule, held) for x in (a, b)]
                assert np.intersect1d(*told).size


def test_told_groups_are_few_and_enough():
    """D + 1 groups for each scheme, whatever they weigh, and linked sets still share one."""
    rng, rule = np.random.default_rng(12), nj.Rule(80)
    sizes = rng.integers(8, 600, 300)
    rows = 0
    for n in sizes:
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        gone = int(rng.integers(0, rule.most_differing(n) + 1))
        fresh = np.unique(rng.integers(0, 2**63, int(rng.integers(0, n // 4 + 1))).astype(np.uint64))
        common = np.sort(rng.choice(a, n // 2, replace=False))
        for b in (a[gone:], np.unique(np.append(a, fresh)), np.unique(np.append(a[gone // 2 :], fresh[: gone // 2]))):
            for held in (common, common[:0]):
                told = [nj.group_hashes(x, rule, held) for x in (a, b)]
                rows += len(told[0])
                if rule.links(len(np.intersect1d(a, b)), len(a) + len(b)) and len(a) != len(b):
                    assert np.intersect1d(*told).size
    assert rows < 0.4 * 6 * sizes.sum()


def test_stars(spark):
    """A hash of many members, over many batches, has one hub."""
    rng = random.Random(3)
    pairs = [(7, k) for k in range(25_000)] + [(rng.randrange(100, 4000), rng.randrange(500)) for _ in range(6000)]
    rng.shuffle(pairs)
    least = {}
    for g, m in pairs:
        least[g] = min(m, least.get(g, m))
    found = nj._stars(spark.createDataFrame(pairs, "grp long, member long")).collect()
    assert sorted(map(tuple, found)) == sorted((g, m, least[g]) for g, m in pairs if m != least[g])


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)] + [(200, 200 + k) for k in range(9)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert dict(rows) == {
        **dict.fromkeys(range(41), 0), 100: 100, 101: 100, **dict.fromkeys(range(200, 209), 200)
    }
    assert len(rows) == 52
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty(spark):
    assert nj.join_ngrams(frame(spark, AWKWARD).limit(0)).count() == 0
