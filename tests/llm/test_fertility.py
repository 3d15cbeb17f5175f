from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
import sentencepiece
from public_tokenizers import path

from skyledger.llm.fertility import Band, SCRIPTS, judge_texts, known_characters
from skyledger.llm.tokens import encoder
from tests.llm.clean import CLEAN
from tests.llm.corpus import AWKWARD, frame

SOME = " ".join(f"word{k}" for k in range(60))
ROWS = [
    *AWKWARD,
    (100, SOME), (101, "a b c d e a b c\nx\n\nx\n x\nx \nlast"), (102, "a a a a\n\n\n"), (103, "b c"),
    (104, "\n".join([SOME, SOME, "#1 $2 <3> |&|", ""])), (105, "日本語のテキスト 😀😀 " * 30),
    (106, "ꙮ𒀀 " * 60), (107, "the cat " * 100), (108, "end a"), (109, "b c\r\nb c\nb c"),
]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def base(text: str) -> tuple:
    split = lambda t: re.findall("[^\x20\x09-\x0d]+", t)
    words = split(text)
    lines = [line for line in text.split("\n") if split(line)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times = Counter(windows)
    again = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    n, r = len(words), len(again)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n


@pytest.fixture(scope="module")
def found(spark):
    return judge_texts(frame(spark, ROWS)).collect()


def test_base(found):
    expected = sorted(((i, *base(t or "")) for i, t in ROWS), key=str)
    assert sorted(((r["doc_id"], *(r[c] for c in BASE)) for r in found), key=str) == expected


def test_measures(found):
    rows = {r["doc_id"]: r for r in found}
    model = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    for doc_id, text in ROWS:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        tokens = [x for w in words for x in encoder().encode_ordinary(" " + w)]
        got = rows[doc_id]
        if doc_id is None or doc_id == 7:
            continue
        assert got["n_tokens"] == len(tokens)
        n = max(len(tokens), 1)
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(tokens).values())
        assert got["entropy"] == pytest.approx(entropy, abs=1e-9)
        assert got["chars_per_token"] == pytest.approx((sum(map(len, words)) + len(words)) / n)
        if len(text) < 5000 and "\r" not in text and "\x0b" not in text:
            strange = sum(model.is_byte(k) for k in model.encode(re.sub("[\x00-\x1f]", "", text)))
            size = max(len(text.encode()), 1)
            assert got["fallback_share"] == pytest.approx(strange / size)


def test_bands_decide(spark, found):
    rows = {r["doc_id"]: r for r in found}
    assert rows[100]["kept"] and not rows[103]["kept"]
    assert rows[106]["base_failed"]
    strict = {"latin": Band((5.0, 9.0), 0.1, 4.0), "other": Band((0.2, 9.0), 0.6, 4.0)}
    again = {r["doc_id"]: r for r in judge_texts(frame(spark, ROWS), strict).collect()}
    assert not again[100]["base_failed"] and not again[100]["kept"]


def test_scripts_have_bands(spark):
    known, rng, rows = known_characters(), random.Random(1), []
    for k, (script, text) in enumerate(CLEAN.items()):
        letters = [chr(c) for s, a, b in SCRIPTS if s == script for c in range(a, b) if chr(c).isalpha()]
        if script not in ("thai", "hangul"):
            letters = [c for c in letters if known[ord(c)]]
        junk = " ".join("".join(rng.choice(letters) for _ in w) for w in text.split())
        rows += [(2 * k, text), (2 * k + 1, junk)]
    rows += [(100, SOME), (101, SOME.replace(" ", " " * 20))]
    got = {r["doc_id"]: r for r in judge_texts(frame(spark, rows)).collect()}
    for k, script in enumerate(CLEAN):
        assert got[2 * k]["script"] == script and got[2 * k]["in_band"], got[2 * k]
        # Random letters of Devanagari and kana that the vocabulary has measure like clean text.
        if script not in ("devanagari", "kana"):
            assert not got[2 * k + 1]["in_band"], got[2 * k + 1]
    assert got[100]["in_band"] and not got[101]["in_band"]


def test_empty(spark):
    assert judge_texts(frame(spark, ROWS).limit(0)).count() == 0
