from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyledger.llm import packing
from tests.llm.corpus import AWKWARD, frame

ROWS = [*AWKWARD, *((k, f"topic{k % 5} " * (k % 90) + "plain words here") for k in range(100, 400))]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def checked(rows, texts, library):
    """Every id of every document in exactly one piece, sequences gapless; the lengths."""
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts}
    copies = defaultdict(int)
    for i, _ in texts:
        copies[i] += 1
    covered, sequences = defaultdict(lambda: defaultdict(int)), defaultdict(list)
    for r in rows:
        if copies[r["doc_id"]] == 1:
            own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
            assert len(own) == r["length"] > 0 and r["doc_tokens"] == len(ids[r["doc_id"]])
            assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
            for k in range(r["start"], r["start"] + r["length"]):
                covered[r["doc_id"]][k] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, own in covered.items():
        assert sorted(own) == list(range(len(ids[i]))) and set(own.values()) == {1}
    assert set(covered) == {i for i, n in copies.items() if n == 1}
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        lengths.append(at)
    assert max(lengths) <= packing.WINDOW
    return lengths


def test_pieces(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 100)
    rows = packing.pack(frame(spark, ROWS)).collect()
    lengths = checked(rows, ROWS, library)
    total = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ROWS)
    assert sum(lengths) == total
    assert sum(n < packing.WINDOW for n in lengths) <= -(-len(ROWS) // 100) + 1


def test_neighbours_share_rare_tokens():
    rests = [np.array([1, 2, 3, 10 + k % 3] * 20, np.uint32) for k in range(30)]
    windows = list(packing.fill(rests, 240))
    assert all(len({10 + r % 3 for r, _, _ in w}) == 1 for w in windows[:5])
    assert sum(to - at for w in windows for _, at, to in w) == 30 * 80


def test_scores_are_bm25():
    rng = np.random.default_rng(1)
    rests = [rng.integers(0, 40, rng.integers(1, 30)).astype(np.uint32) for _ in range(50)]
    index, mean = packing.ShardIndex(rests), np.mean([len(r) for r in rests])
    frequency = {t: sum(t in r for r in rests) for t in range(40)}
    for seed in range(10):
        query = [t for t in set(rests[seed].tolist()) if frequency[t] > 1]
        query.sort(key=lambda t: (frequency[t], t))
        expected = np.zeros(50)
        for t in query[: packing.QUERY_TOKENS]:
            idf = np.log1p((50 - frequency[t] + 0.5) / (frequency[t] + 0.5))
            for k, r in enumerate(rests):
                tf = (r == t).sum()
                expected[k] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(r) / mean)) if tf else 0
        assert index.scores(seed) == pytest.approx(expected)


def test_ranking_goes_on_past_the_best():
    """Ninety rests share the seed's token, every second one; none else gets into its window."""
    rests = [np.array([7] if k % 2 == 0 else [8], np.uint32) for k in range(200)]
    first = next(packing.fill(rests, 90))
    assert [r for r, _, _ in first] == [2 * k for k in range(90)]


def test_every_token_of_the_query_counts():
    """What tells the neighbours apart is the commonest of forty shared tokens."""
    own = list(range(100, 140))
    rests = [np.array([1, 2, *own], np.uint32), *(np.array([t, 3], np.uint32) for t in own)]
    rests += [np.array([1, 3], np.uint32)] * 3 + [np.array([4, 3], np.uint32)] * 3
    scores = packing.ShardIndex(rests).scores(0)
    assert all(scores[1:44] > 0) and all(scores[44:] == 0)


def test_dense_rows_score_as_postings(monkeypatch):
    rng = np.random.default_rng(2)
    rests = [rng.integers(0, 60, rng.integers(1, 80)).astype(np.uint32) for _ in range(300)]
    index = packing.ShardIndex(rests)
    monkeypatch.setattr(packing, "DENSE_SHARE", 1)
    plain = packing.ShardIndex(rests)
    assert len(index._dense) and not len(plain._dense)
    for seed in range(20):
        assert index.scores(seed) == pytest.approx(plain.scores(seed), rel=1e-5)


def test_neighbours_meet_in_a_corpus_of_many_shards(spark, library, monkeypatch):
    """A topic's documents fill windows together, however many shards there are and wherever
    the documents stand; of one token in all of them no shard gets more than its share."""
    monkeypatch.setattr(packing, "SHARD", 60)
    names = ["violin", "harbor", "tomato", "glacier", "pepper", "castle", "rocket", "forest", "marble", "dragon",
             "camera", "bridge", "winter", "planet", "silver", "orange", "button", "ladder", "pillow", "guitar"]
    rows = [(k, f" {names[k % 20]}" * 8 + " the of and to in" * (3 + k % 4)) for k in range(1200)]
    found = packing.pack(frame(spark, rows), window=128).collect()
    windows = defaultdict(lambda: defaultdict(int))
    for r in found:
        windows[r["sequence_id"]][r["doc_id"] % 20] += r["length"]
    checked(found, rows, library)
    own = sum(max(w.values()) for w in windows.values()) / sum(r["length"] for r in found)
    assert own > 0.9


def test_documents_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    lengths = checked(packing.pack(docs).collect(), texts, library)
    assert sum(n < packing.WINDOW for n in lengths) <= 1


def test_empty(spark):
    assert packing.pack(frame(spark, ROWS).limit(0)).count() == 0
