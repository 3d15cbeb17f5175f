from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyledger.llm import bpe
from skyledger.llm.lexicon import Lexicon, compile_lexicon
from tests.llm.corpus import AWKWARD, frame

ROWS = [
    *AWKWARD,
    (100, "It's we'LL they're 12,5 € a<|endoftext|>b<|endoftext|><|endoftext|"),
    (101, " \n\n  x \t y z　 \u0085w "), (102, "ñandú Straße Ωmega 日本語 ꙮ é ²³ Ⅷ x²"),
    (103, "ab" * 40_000 + " " * 5000 + "1" * 5000), (104, "'s's 's ' s"),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def test_same_as_library(spark, library):
    expected = []
    for doc_id, text in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        expected.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(back)))
    found = [tuple(r) for r in bpe.digest_bpe(frame(spark, ROWS), most=30).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_round_trip(spark):
    rows = bpe.encoded(frame(spark, ROWS)).collect()
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in rows) == sorted(
        (str(i), t or "") for i, t in ROWS
    )


def test_memory_is_bounded_not_the_result(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    own = bpe.Codec(bpe.Vocabulary())
    rows = [f"alpha{k} beta{k} " * 3 for k in range(40)] + ["a<|endoftext|>b"]
    found = [x.tolist() for x in own.encode_all(rows)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in rows]
    assert len(own._ids) < 60


def test_long_merges_agree():
    vocabulary, rng = bpe.Vocabulary(), random.Random(5)
    for _ in range(50):
        word = "".join(rng.choice(["the", "a", "an", "ing", "ab", "é", "zz"]) for _ in range(30))
        raw = word.encode()[:100]
        ids = [vocabulary.byte_id[b] for b in raw]
        assert vocabulary._merge_long(ids) == vocabulary.merge(raw)


def test_lexicon_is_minimal_and_exact():
    words = sorted({a + b for a in (b"re", b"un", b"x", b"") for b in (b"ing", b"ed", b"s", b"")})
    lexicon = Lexicon(compile_lexicon((w, [k, k + 1]) for k, w in enumerate(words)))
    assert lexicon.rows(words).tolist() == list(range(len(words)))
    assert lexicon.rows([b"rein", b"zing", b"ss", b"reeds"]).tolist() == [-1] * 4
    assert lexicon.of(3) == [3, 4]
    suffixes = Lexicon(compile_lexicon((w, [1]) for w in [b"aing", b"bing", b"cing"]))
    assert len(suffixes.final) == 5  # one path for the shared ending
    assert Lexicon(compile_lexicon([])).rows([b"a"]).tolist() == [-1]


def test_lexicon_has_the_frequent_words(spark):
    rows = [(k, "often " * 5 + "seldom" * (k == 0) + f" once{k}") for k in range(9)]
    compiled = bpe.frequent_lexicon(frame(spark, rows), bpe.Vocabulary(), most=3)
    assert Lexicon(compiled).rows([b" often", b" once"]).min() >= 0
    assert Lexicon(compiled).rows([b" seldom"])[0] == -1


def test_empty(spark):
    assert bpe.digest_bpe(frame(spark, ROWS).limit(0)).count() == 0
