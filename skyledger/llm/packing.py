"""Lexical retrieval packing: windows of tokens whose documents share rare tokens.

Whole windows of a document stand alone.  What is left of each is sorted by the rarest
tokens that it shares with another rest anywhere in the corpus, and cut into shards of
bounded size: rests of like content meet whatever the size of the corpus, and a token of
many rests goes on to the next rarest ones.  The shard's BM25 inverted index, with the
corpus's own frequencies, ranks all unused neighbours of a seed, which fill the seed's
window.  The last one is cut where the window ends, and its rest is the next seed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import tasks, texts, utf8
from skyledger.llm.tokens import RANKS, encode, encoder
from skyledger.shared import written

WINDOW = 1024
#: Id behind each document.
END = 0
#: Rests of documents in a shard, at least (if there are as many), and below twice as many;
#: a shard is packed at once.
SHARD = 2048
#: A rest is placed by its so many rarest tokens that another rest has, too.
KEY_TOKENS, KEY_BITS = 3, 21
#: A seed asks for its so many rarest tokens; None: for all of them.
QUERY_TOKENS = None
#: Tokens of more than this share of a shard are kept as whole rows of weights.
DENSE_SHARE = 1 / 8
#: BM25's saturation and length normalisation.
K1, B = 1.2, 0.75

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PIECE = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
_CUT = _PIECE.append(pa.field("ids", pa.binary()))
_PACKED = _PIECE.append(pa.field("sequence_id", pa.int64())).append(pa.field("offset", pa.int64()))


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


@dataclass(frozen=True)
class Corpus:
    """How many rests there are, their mean length, and how many of them have each token."""

    rests: int
    mean: float
    frequency: np.ndarray

    def rarity(self) -> np.ndarray:
        """Place of each token from the rarest on; tokens of one rest alone come last, alike."""
        place = np.empty(len(self.frequency), np.int32)
        place[np.argsort(self.frequency, kind="stable")] = np.arange(len(place))
        place[self.frequency < 2] = len(place)
        return place


class _Tally:
    """In how many rests each token is."""

    def __init__(self, vocabulary: int):
        self.times = np.zeros(vocabulary, np.int64)
        self._at = np.zeros(vocabulary, np.int64)

    def add(self, ids: np.ndarray) -> None:
        # Of a token's places the last one written stands for it.
        places = np.arange(len(ids))
        self._at[ids] = places
        self.times[ids[self._at[ids] == places]] += 1

    def told(self) -> pa.RecordBatch:
        token = np.flatnonzero(self.times)
        known = {"start": token, "length": self.times[token]}
        columns = [
            pa.array(known[f.name]) if f.name in known else pa.nulls(len(token), f.type) for f in _CUT
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_CUT)


def _cut(docs: DataFrame, window: int, ranks: str) -> DataFrame:
    """Whole windows (ids null) and rests (with ids) of all documents; and, with ids_crc32
    null, how many rests of a stretch of the input (length) have a token (start)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally(encoder(ranks).n_vocab)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                yield pa.RecordBatch.from_pylist(
                    list(rows(part.column("doc_id"), part.column("text"), tally)), _CUT
                )
        yield tally.told()

    def rows(doc_ids: pa.Array, column: pa.Array, tally: _Tally) -> Iterator[dict]:
        for doc_id, text in zip(doc_ids.to_pylist(), column, strict=True):
            ids = np.append(encode(text.as_py(), ranks), END)
            n = len(ids)
            for start in range(0, n, window):
                own = ids[start : start + window]
                whole = len(own) == window
                if not whole:
                    tally.add(own)
                yield {
                    "doc_id": doc_id, "start": start, "length": len(own), "doc_tokens": n,
                    "ids_crc32": _crc(own), "ids": None if whole else own.astype("<u4").tobytes(),
                }

    return texts(docs).mapInArrow(run, f"{PIECE}, ids binary")


def _corpus(cut: DataFrame, ranks: str) -> Corpus:
    """A row for each token of the vocabulary passes through the driver, whatever the corpus."""
    rests, ids = cut.filter("ids IS NOT NULL").agg(F.count("*"), F.sum("length")).first()
    told = cut.filter("ids_crc32 IS NULL").groupBy("start").agg(F.sum("length").alias("times"))
    frequency = np.zeros(encoder(ranks).n_vocab, np.int64)
    for token, times in told.collect():
        frequency[token] = times
    return Corpus(rests, (ids or 0) / max(1, rests), frequency)


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of rests and where each rest starts (and the end)."""
    data, starts = utf8(column)
    return data.view("<u4"), starts // 4


def rarest(ids: np.ndarray, starts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """The places of each rest's ``KEY_TOKENS`` rarest tokens as one number, rarest first."""
    left, sizes = rarity[ids], np.diff(starts)
    key = np.zeros(len(sizes), np.int64)
    for _ in range(KEY_TOKENS):
        least = np.minimum.reduceat(left, starts[:-1])
        key = key << KEY_BITS | least
        left[left == np.repeat(least, sizes)] = len(rarity)
    return key


def _keyed(rests: DataFrame, corpus: Corpus) -> DataFrame:
    """Rests with ``key``: those of like content have keys that lie together."""
    held = rests.sparkSession.sparkContext.broadcast(corpus.rarity())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = pa.array(rarest(*_ids(batch.column("ids")), held.value))
                yield pa.RecordBatch.from_arrays([*batch.columns, key], [*batch.schema.names, "key"])

    return rests.mapInArrow(run, f"{PIECE}, ids binary, line long, key long")


class ShardIndex:
    """BM25 inverted index over a shard's rests: postings by token, and each rest's query.
    Frequencies and mean length are those of ``corpus``, by default of the shard alone."""

    def __init__(self, rests: list[np.ndarray], corpus: Corpus | None = None):
        n = len(rests)
        size = np.fromiter(map(len, rests), np.int64, n)
        token = np.concatenate(rests).astype(np.int64)
        key, times = np.unique(token * n + np.repeat(np.arange(n), size), return_counts=True)
        token, self.rest = key // n, key % n
        first = np.flatnonzero(np.diff(token, prepend=-1))
        count = np.diff(np.append(first, len(token)))
        total, mean, having = n, size.mean(), count
        if corpus is not None:
            total, mean, having = corpus.rests, corpus.mean, corpus.frequency[token[first]]
        idf = np.repeat(np.log1p((total - having + 0.5) / (having + 0.5)), count)
        saturated = times + K1 * (1 - B + B * size[self.rest] / mean)
        self.weight = idf * times * (K1 + 1) / saturated
        # A rest's query: its tokens that another rest of the shard has, too, rarest first.
        shared = np.flatnonzero(np.repeat(count, count) > 1)
        shared = shared[np.lexsort((token[shared], -idf[shared], self.rest[shared]))]
        self._bounds = np.searchsorted(self.rest[shared], np.arange(n + 1))
        self._row = np.searchsorted(first, shared, "right") - 1
        self._first, self._count, self._n = first, count, n
        # Rows of weights for the tokens of many rests: adding rows up beats their postings.
        dense = np.flatnonzero(count > max(64, n * DENSE_SHARE))
        self._line = np.full(len(first), -1)
        self._line[dense] = np.arange(len(dense))
        posts = _runs(first[dense], count[dense])
        self._dense = np.zeros((len(dense), n), np.float32)
        self._dense[np.repeat(np.arange(len(dense)), count[dense]), self.rest[posts]] = self.weight[posts]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every rest for the seed's query."""
        rows = self._row[self._bounds[seed] : self._bounds[seed + 1]][:QUERY_TOKENS]
        line = self._line[rows]
        rare = rows[line < 0]
        posts = _runs(self._first[rare], self._count[rare])
        found = np.bincount(self.rest[posts], self.weight[posts], self._n)
        return found + np.add.reduce(self._dense[line[line >= 0]], axis=0)


def _runs(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """firsts[0], firsts[0]+1, … (counts[0] of them), firsts[1], …"""
    offsets = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(firsts - offsets, counts)


def fill(
    rests: list[np.ndarray], window: int, corpus: Corpus | None = None
) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (rest, from, to), the seed first.  All but the last are full."""
    index, n = ShardIndex(rests, corpus), len(rests)
    unused = np.ones(n, bool)
    scan, carried = 0, None  # the next rest in order; a cut rest and where it goes on
    while True:
        if carried is None:
            while scan < n and not unused[scan]:
                scan += 1
            if scan == n:
                return
            carried = (scan, 0)
            unused[scan] = False
        seed, at = carried
        carried, room, members = None, window, []
        to = min(len(rests[seed]), at + room)
        members.append((seed, at, to))
        room -= to - at
        if to < len(rests[seed]):
            carried = (seed, to)
        if room:
            for other in _ranked(np.where(unused, index.scores(seed), -1.0)):
                if not room or not unused[other]:
                    break
                unused[other] = False
                to = min(len(rests[other]), room)
                members.append((int(other), 0, to))
                room -= to
                if to < len(rests[other]):
                    carried = (int(other), to)
        yield members


def _ranked(scores: np.ndarray, head: int = 64) -> Iterator[int]:
    """All positions from the highest score down, ties by position.  Few are asked for as a
    rule, so the others are sorted when their turn comes."""
    cut = -np.inf
    if len(scores) > 2 * head:
        cut = np.partition(scores, -head)[-head]
    for part in (scores > cut, scores <= cut):
        at = np.flatnonzero(part)
        yield from at[np.argsort(-scores[at], kind="stable")]


def _pack_shards(window: int, corpus, least: int):
    """Sorted rests, cut into shards of ``least`` or more, as pieces of sequences."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= 2 * least:
                table = pa.Table.from_batches(waiting)
                while table.num_rows >= 2 * least:
                    yield packed(table.slice(0, least))
                    table = table.slice(least)
                waiting = table.to_batches()
        if any(b.num_rows for b in waiting):
            yield packed(pa.Table.from_batches(waiting))

    def packed(table: pa.Table) -> pa.RecordBatch:
        rests = [np.frombuffer(x.as_py(), "<u4") for x in table.column("ids")]
        doc_ids, starts, totals, lines = (
            table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "line")
        )
        rows = []
        for members in fill(rests, window, corpus.value):
            # A rest is the seed of one sequence at most, so it can name it.
            sequence, offset = 2 * lines[members[0][0]] + 1, 0
            for rest, at, to in members:
                rows.append(
                    (doc_ids[rest], starts[rest] + at, to - at, _crc(rests[rest][at:to]), totals[rest],
                     sequence, offset)
                )
                offset += to - at
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_PACKED)

    return run


def pack(docs: DataFrame, window: int = WINDOW, ranks: str = RANKS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids end with ``END``, so a null or empty text has one.  Each id lies in
    exactly one piece; sequences hold ``window`` ids but for the last one of each shard.
    A repeated row is packed as a document of its own; a null doc_id is kept as it is; no
    rows give no rows; other columns are left.
    """
    session = docs.sparkSession
    cut = written(
        _cut(docs, window, ranks).withColumn("line", F.monotonically_increasing_id()), "pieces"
    )
    whole = cut.filter("ids IS NULL AND ids_crc32 IS NOT NULL").select(
        *_PIECE.names, (2 * F.col("line")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rests, corpus = cut.filter("ids IS NOT NULL"), _corpus(cut, ranks)
    parts = max(1, min(4 * tasks(session), corpus.rests // SHARD))
    packed = (
        _keyed(rests, corpus)
        # Rests of one key are told apart by their line, so that a hot one is cut as well.
        .repartitionByRange(parts, "key", "line")
        .sortWithinPartitions("key", "line")
        .mapInArrow(
            _pack_shards(window, session.sparkContext.broadcast(corpus), SHARD),
            f"{PIECE}, sequence_id long, offset long",
        )
    )
    return whole.unionByName(packed)
