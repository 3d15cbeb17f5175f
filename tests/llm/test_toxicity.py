from __future__ import annotations

import math
import pickle
import zlib
from collections import Counter

import numpy as np
import pytest

from skyledger.llm import toxicity
from skyledger.llm.toxicity import BLOCK, build_index, learn, score_toxicity, terms
from tests.llm.corpus import AWKWARD, frame

TABLES = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.001"


def test_nearest_is_exact():
    rng = np.random.default_rng(3)
    words = [f"w{k}".encode() for k in range(40)]
    examples = []
    for i in range(3 * BLOCK + 17):
        own = rng.choice(40, rng.integers(1, 6), replace=False)
        examples.append((i, int(rng.integers(2)), {words[k]: int(rng.integers(1, 4)) for k in own}))
    counts = {w: sum(w in e[2] for e in examples) for w in words}
    index = build_index(examples, 1000, counts, 0.0)
    vectors = {i: index.vector(w for w, c in e.items() for _ in range(c)) for i, _, e in examples}
    for _ in range(60):
        query = index.vector(rng.choice(words, 5))
        cosine = {i: sum(query.get(w, 0) * x for w, x in v.items()) for i, v in vectors.items()}
        expected = sorted(cosine.values(), reverse=True)[:9]
        at, found = index.nearest(query, 9)
        assert found == pytest.approx(expected)
        assert [cosine[i] for i in index.ids[at]] == pytest.approx(expected)


def test_rare_wording_counts(spark):
    """Toxic words in under 2% of the toxic examples, and clean examples, are learned from."""
    common = "some plain words that all of the texts have"
    learned = [k for k in range(4000) if zlib.crc32(str(k).encode()) % 4 != 2][:1000]
    texts = {k: f"{common} clean{k % 7}" if k % 10 else f"{common} loser{k % 3}" for k in learned}
    for k in learned[::10][:2]:
        texts[k] = f"{common} zyxwv qponm"
    toxic = {k: int("clean" not in t) for k, t in texts.items()}
    docs = frame(spark, [*((k, f"{t} own{k}") for k, t in texts.items()), (9001, "zyxwv qponm"), (9002, "clean3")])
    labels = spark.createDataFrame([(k, 0, y) for k, y in toxic.items()], "doc_id long, quality int, toxic int")
    index = learn(docs, labels)
    assert len(index.ids) == 1000 and sorted(index.toxic) == sorted(map(float, toxic.values()))
    rows = {r["doc_id"]: r for r in score_toxicity(docs, labels).filter("doc_id > 9000").collect()}
    assert set(learned[::10][:2]) == set(rows[9001]["evidence"]) and rows[9001]["predicted"]
    assert len(rows[9002]["evidence"]) == 15 and not rows[9002]["predicted"]


def test_terms():
    assert terms("LOSER, l'Été x1y") == [b"loser", b"l", "été".encode(), b"x", b"y"]


def test_query_against_plain_cosine(spark):
    """Every score of sf0.001 from all cosines with all examples."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    told: dict[str, int] = {}
    for r in labels.collect():
        if r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            told[text[r["doc_id"]]] = max(told.get(text[r["doc_id"]], 0), r["toxic"])
    n, n_toxic = len(told), sum(told.values())
    own = [Counter(terms(t)) for t in told]
    toxic = np.array(list(told.values()))
    docs_of, toxic_of = Counter(), Counter()
    for words, y in zip(own, toxic, strict=True):
        docs_of.update(words.keys())
        toxic_of.update(words.keys() if y else ())

    def weight(w):
        c, a = docs_of[w], toxic_of[w]
        sure = n * (a * n - c * n_toxic) ** 2 / max(c * (n - c) * n_toxic * (n - n_toxic), 1)
        return (math.log((1 + n) / (1 + c)) + 1) * (1 + math.sqrt(sure * (a * n > c * n_toxic)))

    def unit(words):
        v = {w: (1 + math.log(x)) * weight(w) for w, x in words.items() if w in docs_of}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()}

    units = [unit(words) for words in own]
    for r in score_toxicity(docs, labels).collect():
        query = unit(Counter(terms(text[r["doc_id"]])))
        cosine = np.array([sum(x * u.get(w, 0) for w, x in query.items()) for u in units])
        near = np.argsort(-cosine, kind="stable")[:15]
        share = ((cosine * toxic)[near].sum() + 0.5 * n_toxic / n) / (cosine[near].sum() + 0.5)
        assert r["score"] == pytest.approx(share, abs=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    rows = score_toxicity(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    test = [r for r in rows if r["held_out"]]
    hits = sum(r["predicted"] and r["toxic"] for r in test)
    assert hits >= 0.9 * sum(r["toxic"] for r in test)
    assert hits >= 0.9 * sum(r["predicted"] for r in test)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["evidence"] for r in rows if r["predicted"])


def test_awkward(spark):
    labels = spark.createDataFrame(
        [(4, 1, 1), (5, 0, None), (9, 0, 0), (9, 0, 0), (None, 0, 1)], "doc_id long, quality int, toxic int"
    )
    docs = frame(spark, AWKWARD)
    rows = score_toxicity(docs, labels).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert score_toxicity(docs, labels.limit(0)).filter("score != 0").count() == 0
    assert score_toxicity(docs.limit(0), labels).count() == 0
    assert learn(docs, labels).blocks == 1


def test_a_block_lies_together_and_more_neighbours_than_a_block_are_exact():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}".replace("0", "o").encode() for i in range(400)]
    counts = [Counter(vocabulary[i] for i in rng.zipf(1.3, 30) % 400) for _ in range(5 * BLOCK)]
    documents = Counter(w for c in counts for w in c)
    index = build_index([(i, 0, c) for i, c in enumerate(counts)], len(counts), documents, 0.0)
    assert all(block.flags.c_contiguous for block in index.dense)
    assert index.dense.shape == (index.blocks, len(index.most), BLOCK)
    k = BLOCK + 20
    order = {i: at for at, i in enumerate(index.ids.tolist())}
    vectors = [index.vector(c.elements()) for c in counts]
    for own in vectors[:3]:
        near, cosines = index.nearest(own, k)
        plain = np.zeros(len(counts))
        for i, other in enumerate(vectors):
            plain[order[i]] = sum(x * other.get(w, 0.0) for w, x in own.items())
        assert np.allclose(np.sort(plain)[::-1][: len(cosines)], cosines, atol=1e-5)
        assert len(near) == min(k, int((plain > 0).sum()))


def test_remembered_words_are_bounded_and_change_no_score(monkeypatch):
    texts = [f"plain w{'abcdefgh'[k % 8]} v{'klmnop'[k % 6]} {'z' * (60 + k % 9)}" for k in range(90)]
    examples = [(k, k % 2, Counter(terms(t))) for k, t in enumerate(texts[:60])]
    counts = Counter(w for _, _, own in examples for w in own)
    plain = build_index(examples, 60, counts, 0.5)
    expected = plain.score(texts)
    assert plain.score(texts) == expected
    assert set(plain.places) == {w for t in texts for w in terms(t) if len(w) < 64}
    monkeypatch.setattr(toxicity, "REMEMBERED", 5)
    few = build_index(examples, 60, counts, 0.5)
    for k, text in enumerate(texts):
        assert few.score([text]) == expected[k : k + 1]
        assert len(few.places) <= 5


def _two_languages(monkeypatch):
    """Index of texts of two vocabularies, some words shared, with rows for each group."""
    monkeypatch.setattr(toxicity, "GROUPED", BLOCK)
    rng = np.random.default_rng(7)
    letters = np.array(list("abcdefghij"))
    words = [["".join(letters[rng.integers(0, 10, 4)]) + end for _ in range(300)] for end in ("x", "y")]
    words[1][:9] = words[0][:9]
    texts = [" ".join(words[k % 2][i] for i in rng.zipf(1.3, 40) % 300) for k in range(9 * BLOCK + 5)]
    counts = [Counter(terms(t)) for t in texts]
    documents = Counter(w for own in counts for w in own)
    examples = [(k, k % 3 == 0, own) for k, own in enumerate(counts)]
    return build_index(examples, len(texts), documents, 0.3), texts, counts


def test_groups_have_rows_of_their_own_and_stay_exact(monkeypatch):
    index, texts, counts = _two_languages(monkeypatch)
    sent = len(pickle.dumps(index))
    index.lay_out()
    assert len(index.cells) > 1 and index.bounds[-1] == index.blocks
    # What isn't 0 alone is sent to workers.
    assert sent < len(pickle.dumps(index))
    for cells in index.cells:
        # A group has no rows for terms that are common elsewhere alone.
        assert all((cells[:, row] > 0).any() for row in range(cells.shape[1]))
    vectors = [index.vector(own.elements()) for own in counts]
    order = {i: at for at, i in enumerate(index.ids.tolist())}
    for own in [*vectors[:6], {**vectors[0], **vectors[1]}]:
        plain = np.zeros(len(texts))
        for i, other in enumerate(vectors):
            plain[order[i]] = sum(x * other.get(w, 0.0) for w, x in own.items())
        near, cosines = index.nearest(own, 15)
        assert np.allclose(np.sort(plain)[::-1][:15], cosines, atol=1e-5)
        assert np.allclose(plain[near], cosines, atol=1e-5)


def test_scores_are_the_same_whatever_the_batch_and_the_groups(monkeypatch):
    index, texts, _ = _two_languages(monkeypatch)
    expected = index.score(texts[:40])
    assert [index.score([t])[0] for t in texts[:40]] == expected
    assert pickle.loads(pickle.dumps(index)).score(texts[:40]) == expected
    monkeypatch.setattr(toxicity, "GROUPS", 1)
    plain, _, _ = _two_languages(monkeypatch)
    scores = [s for s, _ in plain.score(texts[:40])]
    assert len(plain.cells) == 1
    assert scores == pytest.approx([s for s, _ in expected], abs=1e-6)
