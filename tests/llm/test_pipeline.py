from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

import corpus_pipeline
from skyledger.llm.exact_dedup import drop_copies
from skyledger.llm.ngram_join import drop_near_copies
from tests.llm.corpus import AWKWARD, frame
from tests.llm.test_fertility import base
from tests.llm.test_ngram_join import noisy, shingles


@pytest.fixture(scope="module")
def rows():
    rng, out = random.Random(2), list(AWKWARD)
    for g in range(8):
        words = [f"{rng.choice('abcdefgh')}{rng.choice(['tion', 'ing', 'er'])}{k}" for k in range(120 + g)]
        for k in range(6):
            text = noisy(rng, words, 0 if k < 2 else 2 * (k - 2))
            out.append((100 + 10 * g + k, text.replace(" ", "  ", k % 2)))
    out.append((300, " ".join(f"word{k}" for k in range(80)) + " mail me a.b@example.com or 10.0.0.1"))
    out.append((301, "the cat " * 100))
    return out


def staged(spark, docs):
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        found[name] = docs
        if name != "packing":
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    return found


def test_stages(spark, rows):
    docs = frame(spark, rows)
    found = staged(spark, docs)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "near_dedup", "pii", "packing"
    ]
    kept = {name: found[name].collect() for name in found}
    for name in list(found)[:-1]:
        assert found[name].columns == docs.columns
    text = dict(rows)
    good = {r["doc_id"] for r in kept["quality_rules"]}
    assert good == {i for i, t in rows if not base(t or "")[-1]}
    least = {}
    for i in sorted(good):
        least.setdefault(re.sub("[\x20\x09-\x0d]+", " ", text[i]), i)
    assert {r["doc_id"] for r in kept["exact_dedup"]} == set(least.values())
    # The reference link rule of the near stage, by brute force.
    sets = {i: shingles(text[i], 5) for i in least.values()}
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            both = len(sets[i] & sets[j])
            if i < j and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root[i], root[j]))
                root = {k: a if v == b else v for k, v in root.items()}
    assert {r["doc_id"] for r in kept["near_dedup"]} == set(root.values())
    pii = {r["doc_id"]: r for r in kept["pii"]}
    assert set(pii) == set(root.values())
    assert "a.b@" not in pii[300]["text"] and "[email]" in pii[300]["text"]
    assert all(r["text"] == text[i] for i, r in pii.items() if i != 300)
    covered = defaultdict(int)
    for r in kept["packing"]:
        covered[r["doc_id"]] += r["length"]
    assert covered == {r["doc_id"]: r["doc_tokens"] for r in kept["packing"]}
    assert set(covered) == set(pii)


def test_run_on_documents(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert 0 < len({r["doc_id"] for r in rows}) < docs


def test_empty(spark):
    docs = frame(spark, AWKWARD).limit(0)
    for name, found in staged(spark, docs).items():
        assert found.count() == 0, name


def test_one_row_of_each_group_stays(spark):
    """A source loaded twice; columns with the names that the stages use themselves."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for c in ("stay_id", "stays", "row", "number", "grp", "key"):
        docs = docs.withColumn(c, docs["doc_id"])
    for stage, left in ((drop_copies, 189), (drop_near_copies, 187)):
        once, twice = stage(docs).collect(), stage(docs.unionByName(docs)).collect()
        assert len(once) == len(twice) == left and sorted(once) == sorted(twice)
    rows = [(None, "same words here now ok yes")] * 3 + [(5, "same words here  now ok yes"), (None, ""), (None, None)]
    awkward = frame(spark, rows)
    assert [r["doc_id"] for r in drop_copies(awkward).orderBy("doc_id").collect()] == [None, 5]
    more = awkward.unionByName(awkward.filter("doc_id = 5").withColumn("text", awkward["lang"]))
    near = drop_near_copies(more).orderBy("doc_id", "text").collect()
    # A null text is an empty one; one id may have several texts.
    assert [(r["doc_id"], bool(r["text"])) for r in near] == [(None, False), (5, True), (5, True)]
