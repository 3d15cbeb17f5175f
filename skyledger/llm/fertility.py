"""Quality rules by tokeniser fertility.

Public vocabularies measure every whole text: characters per token, the share of bytes
that a vocabulary with byte fallback has no character for, and the entropy of the token
distribution.  Bands per script turn the measures into a verdict.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import pieces, texts, utf8
from skyledger.llm.hashing import Stretches, mix, words
from skyledger.llm.tokens import RANKS, encoder

#: Vocabulary with byte fallback.
PIECES = "piece_bpe_32k.model"
#: Words whose ids a Python worker remembers; then it starts anew.
REMEMBERED = 400_000

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words


@dataclass(frozen=True)
class Band:
    """What a text may measure; outside of it the text is rejected."""

    chars_per_token: tuple[float, float]
    fallback_share: float
    entropy: float
    #: Most blanks among the code points; beyond it a text is padding.
    blank_share: float = 0.5


#: By script.  The lower bound of characters per token finds text that is no language to
#: the vocabulary; it lies between clean text of the script and its known letters at
#: random (tests/llm/clean.py).  Thai and Hangul have hardly a merge in the vocabulary, so
#: there only letters that it lacks tell, as in scripts without a band of their own, which
#: "other" has.  Entropy (bits) finds repetition.
BANDS = {
    "latin": Band((1.6, 9.0), 0.10, 3.5),
    "cyrillic": Band((0.75, 9.0), 0.20, 3.5),
    "greek": Band((0.75, 9.0), 0.20, 3.5),
    "hebrew": Band((0.76, 9.0), 0.20, 3.5),
    "arabic": Band((0.80, 9.0), 0.20, 3.5),
    "devanagari": Band((0.60, 9.0), 0.20, 3.5),
    "thai": Band((0.40, 9.0), 0.20, 3.5),
    "hangul": Band((0.38, 9.0), 0.30, 3.5),
    "kana": Band((0.60, 9.0), 0.20, 3.5),
    "han": Band((0.45, 9.0), 0.20, 3.5),
    "other": Band((0.25, 9.0), 0.60, 3.5),
}
#: Code points of each script: first, and first behind.
SCRIPTS = (
    ("greek", 0x370, 0x400), ("cyrillic", 0x400, 0x530), ("hebrew", 0x590, 0x600),
    ("arabic", 0x600, 0x780), ("devanagari", 0x900, 0x980), ("thai", 0xE00, 0xE80),
    ("hangul", 0x1100, 0x1200), ("greek", 0x1F00, 0x2000), ("kana", 0x3040, 0x3100),
    ("hangul", 0x3130, 0x3190), ("han", 0x3400, 0x4DC0), ("han", 0x4E00, 0xA000),
    ("hangul", 0xAC00, 0xD7B0), ("han", 0xF900, 0xFB00), ("arabic", 0xFB50, 0xFE00),
    ("arabic", 0xFE70, 0xFF00), ("kana", 0xFF66, 0xFFA0), ("han", 0x20000, 0x32000),
)

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, chars_per_token double, fallback_share double, entropy double, "
    "latin_share double, blank_share double, script string"
)


def script_of(wide: np.ndarray) -> str:
    """Script of most of the code points beyond Latin.  Japanese has Han with its kana, so a
    tenth of kana among both is kana."""
    edges = np.array([x for _, *own in SCRIPTS for x in own])
    at = np.searchsorted(edges, wide, "right")
    counts = np.bincount(at, minlength=len(edges) + 1)
    tally = {"other": int(counts[::2].sum())}
    for k, (name, _, _) in enumerate(SCRIPTS):
        tally[name] = tally.get(name, 0) + int(counts[2 * k + 1])
    if 10 * tally["kana"] >= tally["kana"] + tally["han"]:
        tally["kana"] += tally.pop("han")
    return max(tally, key=tally.get)


@functools.cache
def known_characters(pieces_file: str = PIECES) -> np.ndarray:
    """For every code point, whether the vocabulary has it as a piece of its own."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path(pieces_file)
    )
    known = np.zeros(0x110000, bool)
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if len(piece) == 1 and not model.is_byte(k):
            known[ord(piece)] = True
    known[[0x20, 0x2581]] = known[0x2581]
    return known


class _WordIds:
    """Token ids of words, remembered by the words' hashes."""

    def __init__(self):
        self.hashes = np.empty(0, np.uint64)
        self.first = self.count = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)

    def look_up(self, hashes: np.ndarray, spell) -> tuple[np.ndarray, np.ndarray]:
        """Start and count in ``ids`` of each of the distinct ``hashes``; ``spell(k)`` is
        the k-th word's text."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        unseen = (
            np.flatnonzero(self.hashes[at] != hashes) if len(self.hashes) else np.arange(len(hashes))
        )
        if len(unseen):
            if len(self.hashes) + len(unseen) > REMEMBERED:
                self.__init__()
                unseen = np.arange(len(hashes))
            new = [encoder(RANKS).encode_ordinary(spell(k)) for k in unseen]
            sizes = np.fromiter(map(len, new), np.int64, len(new))
            ids = np.fromiter((x for word in new for x in word), np.int32, int(sizes.sum()))
            self._add(hashes[unseen], sizes, ids)
            at = np.searchsorted(self.hashes, hashes)
        return self.first[at], self.count[at]

    def _add(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        first = np.cumsum(sizes) - sizes + len(self.ids)
        if len(self.hashes):
            hashes = np.concatenate([self.hashes, hashes])
            first = np.concatenate([self.first, first])
            sizes = np.concatenate([self.count, sizes])
        order = np.argsort(hashes)
        self.hashes, self.first, self.count = hashes[order], first[order], sizes[order]
        self.ids = np.concatenate([self.ids, ids])


_remembered = _WordIds()


def _runs(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """firsts[0], firsts[0]+1, … (counts[0] of them), firsts[1], …"""
    offsets = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(firsts - offsets, counts)


def _per_text(sorted_owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(sorted_owner, minlength=n)[:n]


def measure(data: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """All measures of texts that lie one behind the other in ``data``."""
    n, size = len(starts) - 1, np.diff(starts)
    owner_of = lambda at: np.searchsorted(starts, at, "right") - 1
    first, last, before = words(data, starts)
    n_words = np.diff(before)
    of_word = np.repeat(np.arange(n), n_words)
    hashed = Stretches(data)
    word = hashed.hash(first, last)

    leads = (data & 0xC0) != 0x80  # first bytes of code points
    points = np.concatenate([[0], np.cumsum(leads)])
    word_chars = np.bincount(of_word, points[last] - points[first], n)[:n]
    symbol = np.isin(data, np.frombuffer(SYMBOLS, np.uint8))
    n_symbols = _per_text(owner_of(np.flatnonzero(symbol)), n)

    # Lines with a word, as hashes together with their text's number.
    breaks = np.flatnonzero(data == 10)
    line_from = np.sort(np.concatenate([starts[:-1], breaks + 1]), kind="stable")
    line_text = np.concatenate([np.arange(n), owner_of(breaks)])
    line_text = line_text[np.argsort(np.concatenate([starts[:-1], breaks + 1]), kind="stable")]
    line_to = np.minimum(
        np.append(line_from[1:], starts[-1]), starts[line_text + 1]
    )
    ends_in_break = np.zeros(len(line_from), bool)
    inner = line_to > line_from
    ends_in_break[inner] = data[line_to[inner] - 1] == 10
    line_to = line_to - ends_in_break
    full = np.searchsorted(first, line_to) > np.searchsorted(first, line_from)
    line_text, line_hash = line_text[full], hashed.hash(line_from[full], line_to[full])
    n_dup_lines = _per_text(line_text, n) - _per_text(_distinct(line_text, line_hash), n)

    # Windows of three words of one text; all words of windows that occur again.
    whole = np.flatnonzero(of_word[2:] == of_word[:-2]) if len(word) > 2 else np.empty(0, np.int64)
    three = hashed_three(word, whole)
    key = mix(three ^ mix(of_word[whole].astype(np.uint64)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key) + 1, bool)
    again[1:][: len(same)] = same
    again[: len(same)] |= same
    windows = whole[order][again[: len(order)]]
    covered = np.zeros(len(word), bool)
    for k in range(3):
        covered[windows + k] = True
    n_repeat = np.bincount(of_word[covered], minlength=n)[:n]

    # Tokens: each word with the blank before it, as the vocabulary has words.
    distinct, sample, which = np.unique(word, return_index=True, return_inverse=True)
    spell = lambda k: " " + data[first[sample[k]] : last[sample[k]]].tobytes().decode()
    at, count = _remembered.look_up(distinct, spell)
    per_word = count[which]
    ids = _remembered.ids[_runs(at[which], per_word)]
    of_token = np.repeat(of_word, per_word)
    n_tokens = _per_text(of_token, n)
    tally = np.sort(of_token.astype(np.int64) << 20 | ids)
    change = np.flatnonzero(np.diff(tally, prepend=-1))
    times = np.diff(np.append(change, len(tally)))
    of_kind = tally[change] >> 20 if len(tally) else np.empty(0, np.int64)
    logs = np.bincount(of_kind, times * np.log2(np.maximum(times, 1)), n)[:n]
    some = np.maximum(n_tokens, 1)
    entropy = np.where(n_tokens > 0, np.log2(some) - logs / some, 0.0)

    # Characters that only bytes can spell, and letters of Latin script.
    fallback, latin, script = np.zeros(n), np.ones(n), np.full(n, "latin", object)
    letters = np.bincount(owner_of(np.flatnonzero(data >= 0x80)), minlength=n)[:n]
    known = known_characters()
    for k in np.flatnonzero(letters):
        text = data[starts[k] : starts[k + 1]].tobytes().decode()
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        wide = chars[chars >= 0x80]
        strange = wide[~known[wide]]
        fallback[k] = (2 + (strange >= 0x800) + (strange >= 0x10000)).sum()
        latin[k] = 1 - (wide >= 0x250).sum() / len(chars)
        if latin[k] < 0.5:
            script[k] = script_of(wide[wide >= 0x250])
    n_points = np.diff(points[starts])
    return {
        "n_words": n_words,
        "word_chars": word_chars.astype(np.int64),
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat,
        "n_tokens": n_tokens,
        "chars_per_token": (word_chars + n_words) / some,
        "fallback_share": fallback / np.maximum(size, 1),
        "entropy": entropy,
        "latin_share": latin,
        "blank_share": 1 - word_chars / np.maximum(n_points, 1),
        "script": script,
    }


def hashed_three(word: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(mix(word[at]) + np.uint64(3) * word[at + 1]) ^ mix(word[at + 2] + np.uint64(1))


def _distinct(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Owners of the distinct (owner, hash) pairs."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[new]


def _measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            found = measure(*utf8(piece.column("text")))
            rest = [piece.column(k) for k in range(piece.num_columns)]
            names = [*piece.schema.names, *found]
            yield pa.RecordBatch.from_arrays([*rest, *map(pa.array, found.values())], names)


def judge(docs: DataFrame, bands: dict[str, Band] = BANDS) -> DataFrame:
    """Rows of ``docs`` (all columns) with the measures, base_failed, in_band and kept.

    Words are runs without blanks.  A text fails the base rules with fewer than
    ``LEAST_WORDS`` words (null and empty texts do) or when over half of its words lie in
    three-word windows that occur again; else its script's band decides.  Rows that repeat
    are judged alike; no rows give no rows.  Columns of ``docs`` must not bear the names
    of the measures (``judge_texts`` has no such limit).
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    measured = docs.mapInArrow(_measured, f"{fields}, {MEASURES}")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    # A script without a band goes by that of "other".
    script = F.when(F.col("script").isin(*bands), F.col("script")).otherwise("other")
    inside = F.lit(False)
    for name, band in bands.items():
        low, high = band.chars_per_token
        good = (
            F.col("chars_per_token").between(low, high)
            & (F.col("fallback_share") <= band.fallback_share)
            & (F.col("entropy") >= band.entropy)
            & (F.col("blank_share") <= band.blank_share)
        )
        inside = F.when(script == name, good).otherwise(inside)
    return measured.select(
        "*", failed.alias("base_failed"), inside.alias("in_band"), (~failed & inside).alias("kept")
    )


def judge_texts(docs: DataFrame, bands: dict[str, Band] = BANDS) -> DataFrame:
    """doc_id, the measures, base_failed, in_band and kept of every document."""
    return judge(texts(docs), bands).drop("text")


def keep_good(docs: DataFrame, bands: dict[str, Band] = BANDS) -> DataFrame:
    """The rows of ``docs``, whatever their columns, that the rules keep."""
    others = [c for c in docs.columns if c != "text"]
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    kept = judge(docs.select(F.struct(*others).alias("row"), text), bands).filter("kept")
    return kept.select(*(c if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
