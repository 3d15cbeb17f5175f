"""Byte-level BPE, encoding and decoding, with a lexicon of the corpus' frequent words.

The words of all documents are counted; the most frequent ones are compiled with their
ids into a lexicon every task maps into memory.  Words it lacks are merged exactly.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import texts
from skyledger.llm.lexicon import Lexicon, compile_lexicon
from skyledger.shared import written

VOCABULARY = "byte_bpe_50k.json"
#: Words in the lexicon.  It bounds memory and the driver's work, not the result.
LEXICON_WORDS = 50_000
#: Words a Python worker remembers, and distinct words it counts, before it starts anew.
REMEMBERED = 1_000_000

_SPACE = r"\t-\r \x85\xa0  -     　"
_GENERAL = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# The same for texts of ASCII and Latin letters only, where a faster matcher knows all classes.
_LETTER = "A-Za-zÀ-ÖØ-öø-ſ"
_LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+"
    rf"| ?[^\t-\r {_LETTER}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
_BEYOND_LATIN = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ſ]")


def pretokens(text: str) -> list[str]:
    plain = text.isascii() or not _BEYOND_LATIN.search(text)
    return (_LATIN if plain else _GENERAL).findall(text)


def _byte_characters() -> dict[str, int]:
    """The characters by which the vocabulary file writes bytes: printable ones stand for
    themselves, the others follow from 256 on in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Merges, the bytes of every id and special strings of a tokenizer file."""

    def __init__(self, name: str = VOCABULARY):
        with open(public_tokenizers.path(name), encoding="utf-8") as file:
            model = json.load(file)
        byte_of = _byte_characters()
        ids = model["model"]["vocab"]
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        self.byte_id = [0] * 256
        for token, i in ids.items():
            if len(token) == 1:
                self.byte_id[byte_of[token]] = i
        #: Pair of ids -> (rank, id); lower ranks merge first.
        self.merges = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[a], ids[b]] = (rank, ids[a + b])
        self.special = {x["content"]: x["id"] for x in model["added_tokens"]}
        self.bytes_of |= {i: text.encode() for text, i in self.special.items()}
        self.special_text = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: of all adjacent pairs the lowest rank merges first, of equal
        ranks the leftmost."""
        ids = [self.byte_id[b] for b in word]
        if len(ids) > 100:
            return self._merge_long(ids)
        find, none = self.merges.get, (1 << 40, -1)
        pairs = [find(p, none) for p in zip(ids, ids[1:], strict=False)]
        while pairs:
            best = min(pairs)
            if best is none:
                break
            k = pairs.index(best)
            ids[k : k + 2] = [best[1]]
            del pairs[k]
            if k:
                pairs[k - 1] = find((ids[k - 1], ids[k]), none)
            if k < len(pairs):
                pairs[k] = find((ids[k], ids[k + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """As ``merge``, with a heap of pairs over a linked list."""
        n, find = len(ids), self.merges.get
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(*found, k) for k in range(n - 1) if (found := find((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, new, k = heapq.heappop(heap)
            j = after[k]
            if ids[k] < 0 or j < 0 or find((ids[k], ids[j]), (0, -1))[1] != new:
                continue
            ids[k], ids[j] = new, -1
            after[k] = after[j]
            if after[j] >= 0:
                before[after[j]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b >= 0 and (found := find((ids[a], ids[b]))):
                    heapq.heappush(heap, (*found, a))
        return [x for x in ids if x >= 0]


class Codec:
    """Encodes and decodes texts; remembers words it has met."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None = None):
        self._vocabulary, self._lexicon = vocabulary, lexicon
        self._special = {t: _packed([i]) for t, i in vocabulary.special.items()}
        self._ids: dict[str, bytes] = dict(self._special)

    def _learn(self, unseen: list[str]) -> None:
        known = self._ids
        if len(known) + len(unseen) > REMEMBERED:
            # Words met first are the frequent ones: the later half goes.
            for word in list(known)[REMEMBERED // 2 :]:
                del known[word]
        spelt = [w.encode() for w in unseen]
        rows = [-1] * len(spelt) if self._lexicon is None else self._lexicon.rows(spelt).tolist()
        merge = self._vocabulary.merge
        for word, raw, row in zip(unseen, spelt, rows, strict=True):
            known[word] = _packed(merge(raw) if row < 0 else self._lexicon.of(row))

    def _words(self, text: str) -> list[str]:
        parts: list[str] = []
        at = 0
        for found in self._vocabulary.special_text.finditer(text):
            parts += [*pretokens(text[at : found.start()]), found[0]]
            at = found.end()
        return parts + pretokens(text[at:]) if at else pretokens(text)

    def encode_all(self, rows: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, special strings as their own ids."""
        group: list[list[str]] = []
        size = 0
        for text in rows:
            group.append(self._words(text))
            size += len(group[-1])
            if size > REMEMBERED // 4:
                yield from self._looked_up(group)
                group, size = [], 0
        yield from self._looked_up(group)

    def _looked_up(self, group: list[list[str]]) -> Iterator[np.ndarray]:
        known = self._ids
        if unseen := set().union(*group).difference(known):
            self._learn(list(unseen))
        for words in group:
            try:
                found = b"".join(map(known.__getitem__, words))
            except KeyError:
                found = b"".join(known.get(w) or self._one(w) for w in words)
            yield np.frombuffer(found, "<i4")

    def _one(self, word: str) -> bytes:
        """A word that had to go while its own group was learned."""
        return self._special.get(word) or _packed(self._vocabulary.merge(word.encode()))

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self._vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes() if len(ids) > 8 else _pack[len(ids)](*ids)


_pack = [struct.Struct(f"<{n}i").pack for n in range(9)]


def word_counts(docs: DataFrame) -> DataFrame:
    """Every pretoken of all texts, words between blanks taken one by one, with its count."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                met.update(text.as_py().encode().split())
                if len(met) > REMEMBERED // 4:
                    yield told(met)
                    met.clear()
        yield told(met)

    def told(met: Counter[bytes]) -> pa.RecordBatch:
        # A word after one blank, as most are, is cut once however often it occurs.
        cut: Counter[str] = Counter()
        for word, times in met.items():
            for piece in pretokens(" " + word.decode()):
                cut[piece] += times
        return pa.RecordBatch.from_arrays(
            [pa.array(list(cut), pa.string()), pa.array(list(cut.values()), pa.int64())],
            ["word", "times"],
        )

    counted = texts(docs).select("text").mapInArrow(count, "word string, times long")
    return counted.groupBy("word").agg(F.sum("times").alias("times"))


def frequent_lexicon(docs: DataFrame, vocabulary: Vocabulary, most: int = LEXICON_WORDS) -> bytes:
    """The corpus' most frequent words, compiled: all words above the lowest frequency
    that ``most`` words at most exceed (frequencies in steps of a sixty-fourth octave)."""
    counted = written(word_counts(docs), "word-counts")
    step = F.floor(F.log2(F.col("times").cast("double")) * 64)
    # A row for each step that occurs: a few thousand whatever the corpus.
    sizes = counted.groupBy(step.alias("step")).count().collect()
    lowest, taken = None, 0
    for row in sorted(sizes, reverse=True):
        if taken + row["count"] > most:
            break
        lowest, taken = row["step"], taken + row["count"]
    top = [] if lowest is None else counted.filter(step >= lowest).select("word").collect()
    words = sorted(r["word"].encode() for r in top)
    return compile_lexicon((w, vocabulary.merge(w)) for w in words)


_codecs: dict[tuple[str, int], Codec] = {}


def codec(name: str, compiled: bytes) -> Codec:
    """This process' codec for a lexicon; a new lexicon replaces the old one."""
    key = (name, hash(compiled))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(Vocabulary(name), Lexicon(compiled))
    return _codecs[key]


def encoded(docs: DataFrame, most: int = LEXICON_WORDS, name: str = VOCABULARY) -> DataFrame:
    """doc_id, ids and decoded text of every document.

    Ids are those of the tokenizers library without added special tokens; the strings of
    special tokens in a text are their ids.  Null and empty texts have no ids.  Repeated
    rows are encoded each; no rows give no rows; other columns are left.
    """
    return _with_codec(
        docs,
        most,
        name,
        lambda ids, text: (ids, text),
        [("ids", pa.list_(pa.int32()), "array<int>"), ("decoded", pa.string(), "string")],
    )


def digest_bpe(docs: DataFrame, most: int = LEXICON_WORDS, name: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids joined by commas), decoded_sha256 of every document."""
    decimal = [str(i) for i in range(60_000)]

    def digest(ids: list[int], text: str) -> tuple:
        joined = ",".join(map(decimal.__getitem__, ids)).encode()
        return (
            len(ids),
            hashlib.sha256(joined).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )

    return _with_codec(
        docs,
        most,
        name,
        digest,
        [
            ("n_tokens", pa.int64(), "long"),
            ("ids_sha256", pa.string(), "string"),
            ("decoded_sha256", pa.string(), "string"),
        ],
    )


def _with_codec(docs: DataFrame, most: int, name: str, make, columns: list[tuple]) -> DataFrame:
    read = texts(docs)
    lexicon = docs.sparkSession.sparkContext.broadcast(
        frequent_lexicon(docs, Vocabulary(name), most)
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(name, lexicon.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = own.encode_all(part.column("text").to_pylist())
                listed = map(np.ndarray.tolist, rows)
                made = [make(ids, own.decode(ids)) for ids in listed]
                arrays = [
                    pa.array([row[k] for row in made], kind) for k, (_, kind, _) in enumerate(columns)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *arrays], ["doc_id", *(c[0] for c in columns)]
                )

    schema = ", ".join(f"{column} {kind}" for column, _, kind in columns)
    return read.mapInArrow(run, f"doc_id long, {schema}")
