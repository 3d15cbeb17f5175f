"""Toxicity by the nearest labelled examples: exact TF-IDF cosine, weighted votes.

Every term of every example counts; those that the labels favour weigh more.  Each
example is a unit vector of term weights.  Examples of like wording (of one language, say)
form a group and lie together in blocks.  Terms common in a group have a row of weights in
each of its blocks, and their largest weight in it; the rest of each term is a list of
examples.  Texts are searched in batches, those of like wording together: a block is read
for the texts whose bound in it reaches their nearest examples found so far, so these are
exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import pieces, texts

#: Labelled rows that are learned from: at most so many, chosen by a hash of their ids.
EXAMPLES = 40_000
#: Examples of one block, neighbours that vote, and texts of one search.
BLOCK = 128
NEIGHBOURS = 15
#: Blocks that a text reads at first.
FIRST = 16
BATCH = 256
#: Terms in over a share of 1 / COMMON of a group's examples are common there: their rows
#: hold at most COMMON times what their lists would.
COMMON = 16
#: Groups at most, examples that each has on average at least, and what groups are told by:
#: the most frequent terms, for centres so many examples and rounds.
GROUPS = 8
GROUPED = 8 * BLOCK
FREQUENT = 1024
SAMPLE = 4096
ROUNDS = 8
#: Bytes of the texts among which those of like wording are put together.
PIECE = 8 << 20
#: Covers the rounding of products in single precision.
ROUNDING = 1e-5
#: Words whose places are kept in mind, at most so many, of under 64 bytes each.
REMEMBERED = 1 << 18
LONG = 32
#: Weight of the prior beside the neighbours' similarities.
PRIOR_WEIGHT = 0.5
THRESHOLD = 0.3

# Lower case letters and bytes beyond ASCII make words; all else parts them.
_TABLE = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """The words of a text, in lower case."""
    return text.lower().encode().translate(_TABLE).split()


def hashed(words: Iterable[bytes]) -> np.ndarray:
    """64-bit hash of each word, as signed numbers."""
    return np.frombuffer(b"".join([blake2b(w, digest_size=8).digest() for w in words]), np.int64)


@dataclass
class Index:
    """Examples in blocks of ``BLOCK``, the last one filled up with empty ones."""

    prior: float
    #: Hashes of all terms in order, and their weights.
    words: np.ndarray
    weights: np.ndarray
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    toxic: np.ndarray = field(default_factory=lambda: np.empty(0))
    #: Where each group's blocks and rows start (and the end).
    bounds: list[int] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    #: Of each term its line in ``number``, the first one for terms that are common nowhere;
    #: by line and group the row, or -1; the mean weight of each row (of none, at last).
    line: np.ndarray | None = None
    number: np.ndarray | None = None
    centre: np.ndarray | None = None
    #: Of each group the shape, and the places and weights that aren't 0, until these are
    #: laid out: weights by block, row and example of the block; the largest by row and block.
    filled: list[tuple[tuple[int, ...], np.ndarray, np.ndarray]] = field(default_factory=list)
    cells: list[np.ndarray] = field(default_factory=list)
    tops: list[np.ndarray] = field(default_factory=list)
    #: Where each term's list starts (and the end), and the lists: examples of groups in
    #: which it isn't common, each (upper half) with its weight in one 64-bit cell.
    starts: np.ndarray | None = None
    lists: np.ndarray | None = None
    #: Positions of words met so far, -1 for those that are no terms.
    places: dict[bytes, int] = field(default_factory=dict)
    #: Lists met so far of over ``LONG`` examples; room for the sums and scores of a batch.
    kept: dict[int, np.ndarray] = field(default_factory=dict)
    room: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"places": {}, "kept": {}, "room": None}

    def __setstate__(self, state: dict) -> None:
        # Arrays that numpy sets up itself lie in large pages, those of a pickle don't.
        for name, value in state.items():
            state[name] = value.copy() if isinstance(value, np.ndarray) else value
        self.__dict__.update(state)

    def lay_out(self) -> None:
        """Blocks from what isn't 0 in them, which is what workers are sent."""
        for shape, place, x in self.filled:
            cells = np.zeros(shape, np.float32)
            cells.reshape(-1)[place] = x
            self.cells.append(cells)
            self.tops.append(np.ascontiguousarray(cells.max(2).T, float))
        self.filled = []

    @property
    def blocks(self) -> int:
        return -(-len(self.ids) // BLOCK)

    @property
    def dense(self) -> np.ndarray:
        """Weights of all blocks in one array, rows filled up to the most of a group."""
        self.lay_out()
        rows = max(np.diff(self.rows))
        return np.concatenate([np.pad(c, ((0, 0), (0, rows - c.shape[1]), (0, 0))) for c in self.cells])

    @property
    def most(self) -> np.ndarray:
        """The largest weights by row and block, in the rows of ``dense``."""
        return self.dense.max(2).T

    def _known(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are terms, and their positions."""
        at = np.searchsorted(self.words, words)
        known = np.flatnonzero(at < len(self.words))
        known = known[self.words[at[known]] == words[known]]
        return known, at[known]

    def positions(self, words: list[bytes]) -> np.ndarray:
        """Position of each word, -1 for those that are no terms."""
        found = np.fromiter(map(self.places.get, words, repeat(-2)), np.int64, len(words))
        new = np.flatnonzero(found == -2)
        if len(new):
            unseen = [words[k] for k in new.tolist()]
            own = list(dict.fromkeys(unseen))
            known, at = self._known(hashed(own))
            place = np.full(len(own), -1)
            place[known] = at
            places = dict(zip(own, place.tolist(), strict=True))
            found[new] = np.fromiter(map(places.__getitem__, unseen), np.int64, len(unseen))
            if len(self.places) + len(own) > REMEMBERED:
                self.places.clear()
            if len(own) <= REMEMBERED:
                self.places.update((w, at) for w, at in places.items() if len(w) < 64)
        return found

    def unit(self, at: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Values of the unit vector, (1 + log tf) weight, of the terms ``at``."""
        raw = (1 + np.log(times)) * self.weights[at]
        length = np.sqrt((raw * raw).sum())
        return raw / length if length else raw

    def vector(self, words: Iterable[bytes]) -> dict[bytes, float]:
        """Unit vector of a text's words."""
        counts = Counter(words)
        own = list(counts)
        known, at = self._known(hashed(own))
        values = self.unit(at, np.fromiter(counts.values(), float, len(own))[known])
        return {own[k]: float(x) for k, x in zip(known, values, strict=True)}

    def nearest(self, query: dict[bytes, float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples, ties by position."""
        known, at = self._known(hashed(query))
        return self.search([(at, np.fromiter(query.values(), float, len(query))[known])], k)[0]

    def search(
        self, queries: list[tuple[np.ndarray, np.ndarray]], k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of several vectors (terms and values)."""
        if not len(self.ids):
            return [(np.empty(0, np.int64), np.empty(0)) for _ in queries]
        self.lay_out()
        width = self.blocks * BLOCK
        group = np.repeat(np.arange(len(self.cells)), np.diff(self.bounds))
        rows = [slice(a, b) for a, b in zip(self.rows, self.rows[1:], strict=False)]
        if self.room is None or len(self.room[0]) < len(queries):
            self.room = np.empty((len(queries), width)), np.empty((len(queries), width), np.float32)
        rare, scores = (held[: len(queries)] for held in self.room)
        scores.fill(-1)
        common = np.zeros((len(queries), self.rows[-1]))
        for i, (at, x) in enumerate(queries):
            places = self.number[self.line[at]]
            own = places >= 0
            common[i, places[own]] = np.repeat(x, own.sum(1))
            rare[i] = self._sums(at, x, width)
        bound = rare.reshape(len(queries), self.blocks, BLOCK).max(2)
        for g, top in enumerate(self.tops):
            bound[:, self.bounds[g] : self.bounds[g + 1]] += common[:, rows[g]] @ top
        single = common.astype(np.float32)

        def read(wanted: np.ndarray) -> None:
            """``wanted``: texts that need a block, by text and block."""
            needed = wanted.sum(0)
            for b in np.flatnonzero(needed).tolist():
                cells = slice(b * BLOCK, (b + 1) * BLOCK)
                # A few products too many cost less than taking the others apart.
                some = slice(None) if 4 * needed[b] > 3 * len(queries) else np.flatnonzero(wanted[:, b])
                weights = self.cells[g := group[b]][b - self.bounds[g]]
                scores[some, cells] = single[some, rows[g]] @ weights + rare[some, cells]

        # The most promising blocks first, which tell what the others have to reach: the k-th
        # best score of each text so far.
        first = np.argsort(-bound, 1, kind="stable")[:, : max(FIRST, 1 + k // BLOCK)]
        promising = np.zeros(bound.shape, bool)
        np.put_along_axis(promising, first, True, 1)
        read(promising)
        least = np.zeros(len(queries))
        if width > k:
            found = np.take_along_axis(
                scores.reshape(bound.shape + (BLOCK,)), first[:, :, None], 1
            ).reshape(len(queries), -1)
            place = found.shape[1] - k
            least = np.maximum(np.partition(found, place)[:, place], 0)
        read((bound + ROUNDING >= least[:, None]) & ~promising)
        nearest = []
        for i in range(len(queries)):
            able = np.flatnonzero(scores[i] >= np.float32(least[i] - ROUNDING))
            if len(able) > k:
                own = scores[i, able]
                able = able[own >= np.partition(own, len(own) - k)[len(own) - k] - ROUNDING]
            nearest.append(self._ordered(able, group[able // BLOCK], rare[i], common[i], k))
        return nearest

    def _sums(self, at: np.ndarray, x: np.ndarray, width: int) -> np.ndarray:
        """Sums of products of the lists of the terms ``at`` with every example."""
        first, end = self.starts[at], self.starts[at + 1]
        kept = self.kept
        held = [kept[t] if t in kept else self._list(t) for t in at.tolist()]
        cells = np.concatenate([*held, np.empty(0, np.int64)])
        products = cells.view(np.float32)[::2] * np.repeat(x, end - first)
        return np.bincount(cells >> 32, products, width)

    def _list(self, term: int) -> np.ndarray:
        own = self.lists[self.starts[term] : self.starts[term + 1]]
        if len(own) > LONG and len(self.kept) < REMEMBERED:
            self.kept[term] = own
        return own

    def _ordered(
        self, able: np.ndarray, group: np.ndarray, rare: np.ndarray, common: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest of some examples, in double precision, whatever the batch."""
        full = rare[able]
        for g in set(group.tolist()):
            some, first, end = np.flatnonzero(group == g), self.rows[g], self.rows[g + 1]
            own = np.flatnonzero(common[first:end])
            block = (able[some] // BLOCK - self.bounds[g]) * (end - first)
            cells = self.cells[g].reshape(-1).take((block + own[:, None]) * BLOCK + able[some] % BLOCK)
            full[some] += (cells * common[first + own, None]).sum(0)
        order = np.lexsort((able, -full))[:k]
        order = order[full[order] > 0]
        return able[order], full[order]

    def _alike(self, at: np.ndarray, x: np.ndarray) -> int:
        """The group whose mean a vector is closest to."""
        return int((x @ self.centre[self.number[self.line[at]]]).argmax())

    def score(self, texts: list[str]) -> list[tuple[float, list[int]]]:
        """Of each text the share of toxic votes, each neighbour's vote weighing its
        cosine, and the neighbours' ids."""
        queries = []
        for first in range(0, len(texts), BATCH):
            words = [terms(text) for text in texts[first : first + BATCH]]
            text_of = np.repeat(np.arange(len(words)), [len(own) for own in words])
            at = self.positions([w for own in words for w in own])
            known = at >= 0
            met, times = np.unique(text_of[known] * len(self.words) + at[known], return_counts=True)
            ends = np.searchsorted(met, np.arange(len(words) + 1) * len(self.words)).tolist()
            at = met % max(len(self.words), 1)
            for a, b in zip(ends, ends[1:], strict=False):
                queries.append((at[a:b], self.unit(at[a:b], times[a:b])))
        order = list(range(len(texts)))
        if len(self.ids):
            alike = [self._alike(*query) for query in queries]
            order.sort(key=alike.__getitem__)
        found: list[tuple[float, list[int]]] = [(0.0, [])] * len(texts)
        for first in range(0, len(texts), BATCH):
            batch = order[first : first + BATCH]
            for i, (near, cosine) in zip(batch, self.search([queries[i] for i in batch], NEIGHBOURS), strict=True):
                votes = float((cosine * self.toxic[near]).sum() + PRIOR_WEIGHT * self.prior)
                found[i] = votes / (float(cosine.sum()) + PRIOR_WEIGHT), self.ids[near].tolist()
        return found


def _grouped(vectors: list[tuple[np.ndarray, np.ndarray]], size: np.ndarray) -> np.ndarray:
    """Group of each vector (terms and values) by spherical k-means over the most frequent
    terms.  Groups settle where examples lie, never what is found."""
    groups = min(GROUPS, len(vectors) // GROUPED)
    if groups < 2:
        return np.zeros(len(vectors), int)
    frequent = np.argsort(-size, kind="stable")[:FREQUENT]
    column = np.full(len(size), -1)
    column[frequent] = np.arange(len(frequent))

    def rows(part: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        own = np.concatenate([column[at] for at, _ in part])
        row = np.repeat(np.arange(len(part)), [len(at) for at, _ in part])
        made = np.zeros((len(part), len(frequent)), np.float32)
        made[row[own >= 0], own[own >= 0]] = np.concatenate([x for _, x in part])[own >= 0]
        return made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)

    sample = rows(vectors[:: -(-len(vectors) // SAMPLE)])
    rng = np.random.default_rng(0)
    centres = sample[:1]
    for _ in range(groups - 1):
        far = np.maximum(1 - (sample @ centres.T).max(1), 0).astype(float) ** 2 + 1e-12
        centres = np.vstack([centres, sample[rng.choice(len(sample), p=far / far.sum())]])
    for _ in range(ROUNDS):
        nearest = (sample @ centres.T).argmax(1)
        sums = np.stack([sample[nearest == g].sum(0) for g in range(groups)])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    parts = (vectors[first : first + SAMPLE] for first in range(0, len(vectors), SAMPLE))
    return np.concatenate([(rows(part) @ centres.T).argmax(1) for part in parts])


def _built(
    examples: Iterable[tuple[int, int, np.ndarray, np.ndarray]], words: np.ndarray,
    weights: np.ndarray, prior: float,
) -> Index:
    """``examples``: id, label, distinct hashes and their counts; ``words`` in order."""
    index = Index(prior, words, weights)
    vectors = []
    for i, y, own, times in examples:
        known, at = index._known(own)
        values = index.unit(at, times[known])
        strongest = int(at[np.lexsort((at, -values))[0]]) if len(at) else -1
        vectors.append((strongest, i, y, at.astype(np.int32), values.astype(np.float32)))
    if not vectors:
        return index
    # Examples of a group lie together, in it those with the same strongest term: block
    # maxima are then close.
    vectors.sort(key=lambda v: v[1])
    size = np.bincount(np.concatenate([v[3] for v in vectors]), minlength=len(words))
    group = _grouped([v[3:] for v in vectors], size)
    order = sorted(range(len(vectors)), key=lambda k: (group[k], vectors[k][:2]))
    vectors = [vectors[k] for k in order]
    index.ids = np.array([v[1] for v in vectors], np.int64)
    index.toxic = np.array([v[2] for v in vectors], float)
    # A block with examples of two groups goes with its first one.
    blocks_of = group[order][::BLOCK]
    edges = np.flatnonzero(np.diff(blocks_of)) + 1
    index.bounds = [0, *edges.tolist(), index.blocks]
    lengths = np.array([len(v[3]) for v in vectors])
    ends = np.concatenate([[0], np.cumsum(lengths)])
    owner = np.repeat(np.arange(len(vectors), dtype=np.int32), lengths)
    at = np.concatenate([v[3] for v in vectors])
    values = np.concatenate([v[4] for v in vectors])
    del vectors
    parts = [
        slice(ends[a * BLOCK], ends[min(b * BLOCK, len(lengths))])
        for a, b in zip(index.bounds, index.bounds[1:], strict=False)
    ]
    index.rows = [0]
    commons, centres = [], []
    size = np.zeros(len(words), int)
    listed = np.ones(len(at), bool)
    for g, part in enumerate(parts):
        blocks = index.bounds[g + 1] - index.bounds[g]
        own = np.bincount(at[part], minlength=len(words))
        common = np.flatnonzero(own * COMMON > blocks * BLOCK)
        row_of = np.full(len(words), -1, np.int32)
        row_of[common] = np.arange(len(common))
        row = row_of[at[part]]
        k = np.flatnonzero(row >= 0)
        listed[part] = row < 0
        row, example, x = row[k], owner[part][k] - index.bounds[g] * BLOCK, values[part][k]
        shape = (blocks, len(common), BLOCK)
        place = (example.astype(np.int64) // BLOCK * len(common) + row) * BLOCK + example % BLOCK
        index.filled.append((shape, place.astype(np.min_scalar_type(int(np.prod(shape)))), x))
        mean = np.bincount(row, x, len(common))
        centres.append(mean / (np.linalg.norm(mean) or 1))
        commons.append(common)
        index.rows.append(index.rows[g] + len(common))
        own[common] = 0
        size += own
    anywhere = np.unique(np.concatenate(commons))
    index.line = np.zeros(len(words), np.int32)
    index.line[anywhere] = np.arange(len(anywhere)) + 1
    index.number = np.full((len(anywhere) + 1, len(parts)), -1, np.int32)
    for g, common in enumerate(commons):
        index.number[index.line[common], g] = np.arange(len(common)) + index.rows[g]
    index.centre = np.concatenate([*centres, [0.0]])
    index.starts = np.concatenate([[0], np.cumsum(size)])
    at, owner, values = at[listed], owner[listed], values[listed]
    order = np.argsort(at, kind="stable")
    index.lists = np.empty(len(at), np.int64)
    index.lists.view(np.int32)[1::2], index.lists.view(np.float32)[::2] = owner[order], values[order]
    return index


def build_index(
    examples: list[tuple[int, int, dict[bytes, int]]], n: int, document_counts: dict[bytes, int],
    prior: float,
) -> Index:
    """``examples``: id, label and term counts; ``n``: of all.  Terms weigh their idf."""
    idf = np.array([np.log((1 + n) / (1 + c)) + 1 for c in document_counts.values()])
    words = hashed(document_counts)
    order = np.argsort(words)
    own = (
        (i, y, hashed(counts), np.fromiter(counts.values(), float, len(counts)))
        for i, y, counts in examples
    )
    return _built(own, words[order], idf[order], prior)


def held_out() -> Column:
    """Rows that are never learned from; a null id isn't among them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _chosen(labels: DataFrame, examples: int) -> DataFrame:
    """Id and label of the rows to learn from, ``examples`` at most."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)


def learn(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Index:
    """Index of labelled examples.  Texts that occur several times count once; a text
    whose labels differ is toxic.

    A term weighs its idf times 1 + the root of chi-square, if toxic examples have it more
    often: a rare word's root tells how sure the labels are and does not change with the
    number of other examples.  No term is left out.  With fewer than ``NEIGHBOURS``
    examples those that share a term vote; the prior is the toxic share, 0 without labels.
    """
    chosen = F.broadcast(_chosen(labels, examples))
    rows = texts(docs).join(chosen, "doc_id").groupBy(F.sha2("text", 256)).agg(
        F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"), F.first("text").alias("text")
    )

    def words_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                tallies = [Counter(terms(t.as_py())) for t in part.column("text")]
                own = [hashed(t) for t in tallies]
                times = [np.fromiter(t.values(), np.int32, len(t)) for t in tallies]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("toxic"),
                        pa.array(own, pa.list_(pa.int64())),
                        pa.array([w.tobytes() for w in own], pa.binary()),
                        pa.array([t.tobytes() for t in times], pa.binary()),
                    ],
                    ["doc_id", "toxic", "words", "packed", "times"],
                )

    # At most EXAMPLES texts: kept while terms are counted and vectors made.
    counted = rows.select("doc_id", "toxic", "text").mapInArrow(
        words_of, "doc_id long, toxic int, words array<bigint>, packed binary, times binary"
    ).persist(StorageLevel.DISK_ONLY)
    try:
        totals = counted.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
        n, n_toxic = totals["n"], totals["toxic"] or 0
        prior = n_toxic / n if n else 0.0
        per_term = (
            counted.select("toxic", F.explode("words").alias("word"))
            .groupBy("word")
            .agg(F.sum("toxic").alias("a"), F.count("*").alias("docs"))
            .toArrow()
        )
        word, a, docs_of = (per_term.column(c).to_numpy() for c in ("word", "a", "docs"))
        del per_term
        order = np.argsort(word)
        word, a, docs_of = word[order], a[order].astype(float), docs_of[order].astype(float)
        sure = (a * n - docs_of * n_toxic) ** 2 * n
        sure /= np.maximum(docs_of * (n - docs_of) * n_toxic * (n - n_toxic), 1.0)
        sure[a * n <= docs_of * n_toxic] = 0.0
        weights = (np.log((1 + n) / (1 + docs_of)) + 1) * (1 + np.sqrt(sure))
        found = (
            (r["doc_id"], r["toxic"], np.frombuffer(r["packed"], np.int64),
             np.frombuffer(r["times"], np.int32).astype(float))
            for r in counted.drop("words").toLocalIterator()
        )
        return _built(found, word, weights, prior)
    finally:
        counted.unpersist()


def score_toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (ids of the nearest examples).

    Scores depend on the text alone.  A text without any term of the examples, so an empty
    or null one, scores their toxic share.  Repeated rows are scored
    each; no rows give no rows; other columns are left.
    """
    index = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, examples))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            for part in pieces(batch, PIECE):
                found = own.score(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([s for s, _ in found], pa.float64()),
                        pa.array([e for _, e in found], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "score", "evidence"],
                )

    scored = texts(docs).mapInArrow(run, "doc_id long, score double, evidence array<bigint>")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )
