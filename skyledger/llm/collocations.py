"""Phrase collocations by Misra-Gries summaries and a second, exact pass.

First pass: runs of words of one to three are hashed; each stretch of text tells, per hash
partition, a summary of its runs.  The summaries of a partition are merged with a capacity
above its mass divided by the threshold, so that every run that reaches the threshold keeps
a counter; a run whose counter and the most it can have lost stay below the threshold is
ruled out.  The survivors set bits in a filter of fixed size.

Second pass: runs that the filter lets through are told as text and counted exactly, so
what it lets through wrongly falls to the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import tasks, utf8
from skyledger.llm.hashing import Stretches, mix
from skyledger.shared import written

THRESHOLD = 10
LONGEST = 3
BEST = 2000
#: A longer candidate with this percentage of a shorter one's count takes its place.
COVERED = 50
#: Texts are worked on in stretches of about so many bytes, cut between pieces.
STRETCH = 2 << 20
#: Bytes of text whose runs make up one hash partition.
PARTITION = 6 << 20
#: Bits of the filter (16 MB): for up to about 10 million frequent runs hardly anything else
#: passes.  With more, it lets more through, which costs a larger second shuffle, not results.
FILTER_BITS = 1 << 27
_BITMAP = 1 << 15
#: Each language's best are taken from so many parts first, so that none is ranked whole.
PARTS = 64

_WORD, _GAP, _END = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _GAP
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


class Runs:
    """Words of one stretch of bytes and the hashes of all runs of one to three of them."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, langs: np.ndarray):
        """``edges`` has where each text starts in ``data``, ``langs`` a hash for each."""
        self.data = _LOWER[data]
        kind = _KIND[self.data]
        solid = np.zeros(len(data) + 2, bool)
        np.equal(kind, _WORD, out=solid[1:-1])
        edge = np.zeros(len(data) + 1, bool)
        edge[edges] = True
        edge[-1] = True
        self.starts = np.flatnonzero(solid[1:] & (~solid[:-1] | edge))
        self.ends = np.flatnonzero(solid[:-1] & (~solid[1:] | edge))
        ended = np.cumsum(edge[:-1] | (kind == _END), dtype=np.int32)
        piece = ended[self.starts]
        self.text = np.searchsorted(edges, self.starts, "right") - 1
        lang = langs[self.text]
        word = Stretches(self.data).hash(self.starts, self.ends)
        keys = [mix(word * _ODD[0] + lang)]
        at = [np.arange(len(word))]
        for size in range(2, LONGEST + 1):
            at.append(np.flatnonzero(piece[size - 1 :] == piece[: len(piece) - size + 1]))
            last = word[at[-1] + size - 1] + np.uint64(size)
            before = _before(at[-2], at[-1], keys[-1])
            keys.append(mix(before * _ODD[size - 1] + last))
        self.keys, self.first = np.concatenate(keys), np.concatenate(at)
        self.size = np.repeat(np.arange(1, LONGEST + 1), [len(x) for x in at])

    def spell(self, runs: np.ndarray) -> list[bytes]:
        """Runs as text, one space between words."""
        first, size = self.first[runs], self.size[runs]
        last = first + size - 1
        held = self.data.tobytes()
        begins, ends = self.starts[first], self.ends[last]
        lengths = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        plain = ends - begins == lengths[last + 1] - lengths[first] + size - 1
        return [
            piece if one and b"\t" not in piece else b" ".join(piece.split())
            for one, piece in zip(
                plain.tolist(),
                (held[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)),
                strict=True,
            )
        ]


def _before(longer: np.ndarray, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Keys of the runs one word shorter that start at the same words."""
    return keys[np.searchsorted(longer, at)]


def stretches(batch: pa.RecordBatch) -> Iterator[tuple[Runs, list[str]]]:
    """The runs of a batch's texts, a bounded stretch of whole pieces at a time."""
    data, starts = utf8(batch.column("text"))
    langs = batch.column("lang").to_pylist()
    hashes = {x: _hash(x) for x in set(langs)}
    told = np.array([hashes[x] for x in langs], np.uint64)
    after = np.flatnonzero(_KIND[data] == _END) + 1
    cuts = np.union1d(np.union1d(after, starts), [len(data)])
    begin = 0
    while begin < len(data):
        k = int(np.searchsorted(cuts, begin + STRETCH, "right")) - 1
        end = int(cuts[k] if cuts[k] > begin else cuts[k + 1])
        first = int(np.searchsorted(starts, begin, "right")) - 1
        last = int(np.searchsorted(starts, end, "left"))
        edges = np.maximum(starts[first:last] - begin, 0)
        yield Runs(data[begin:end], edges, told[first:last]), langs[first:last]
        begin = end


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")


def merge_summaries(
    summaries: Iterable[tuple[np.ndarray, np.ndarray]], capacity: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """Misra-Gries counters of all summaries together, at most ``capacity`` of them, and how
    much any of them can have lost: at most the mass divided by ``capacity + 1``."""
    keys, counts, lost = np.empty(0, np.uint64), np.empty(0, np.int64), 0
    waiting, size = [], 0

    def merged(keys, counts, lost):
        keys, counts = added([(keys, counts), *waiting])
        if len(keys) > capacity:
            off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
            counts = counts - off
            keys, counts, lost = keys[counts > 0], counts[counts > 0], lost + off
        return keys, counts, lost

    for one in summaries:
        waiting.append(one)
        size += len(one[0])
        if size > capacity:
            keys, counts, lost = merged(keys, counts, lost)
            waiting, size = [], 0
    return merged(keys, counts, lost)


def added(summaries: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in summaries])
    counts = np.concatenate([c for _, c in summaries])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[begins], np.add.reduceat(counts, begins)


def places(keys: np.ndarray) -> list[np.ndarray]:
    """Two bits of the filter for each key."""
    mask = np.uint64(FILTER_BITS - 1)
    return [keys & mask, (keys >> np.uint64(34)) & mask]


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def frequent_filter(docs: DataFrame, threshold: int = THRESHOLD) -> np.ndarray:
    """Bits of all runs that may reach the threshold in their language: every one that does
    is among them.  As bytes, of a fixed number."""
    read = _read(docs)
    spark = docs.sparkSession
    size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(tasks(spark), size // PARTITION + 1)

    def summarise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for runs, _ in stretches(batch):
                keys, counts = np.unique(runs.keys, return_counts=True)
                part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])[: len(part)])
                ends = [*begins[1:].tolist(), len(keys)]
                counts = counts.astype(np.uint32)
                cut = list(zip(begins.tolist(), ends, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[begins].astype(np.int64)),
                        pa.array([keys[a:b].tobytes() for a, b in cut], pa.binary()),
                        pa.array([counts[a:b].tobytes() for a, b in cut], pa.binary()),
                    ],
                    ["part", "keys", "counts"],
                )

    def survive(group: pa.Table) -> pa.Table:
        summaries = [
            (np.frombuffer(k.as_py(), np.uint64), np.frombuffer(c.as_py(), np.uint32).astype(np.int64))
            for k, c in zip(group.column("keys"), group.column("counts"), strict=True)
        ]
        mass = sum(int(c.sum()) for _, c in summaries)
        keys, counts, lost = merge_summaries(summaries, mass // threshold + 1)
        kept = keys[counts + lost >= threshold]
        # Bitmaps number their bits from 1.
        bits = np.unique(np.concatenate(places(kept))).astype(np.int64) + 1
        return pa.table({"bit": pa.array(bits)})

    summaries = read.mapInArrow(summarise, "part long, keys binary, counts binary")
    bits = summaries.groupBy("part").applyInArrow(survive, "bit long")
    maps = bits.groupBy(F.bitmap_bucket_number("bit").alias("map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    # As many rows as the filter has maps, at most, whatever the corpus.
    found = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in maps.toLocalIterator():
        at = (row["map"] - 1) * _BITMAP // 8
        found[at : at + _BITMAP // 8] = np.frombuffer(row["bits"], np.uint8)
    return found


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    kept = np.ones(len(keys), bool)
    for place in places(keys):
        kept &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return kept


def run_counts(docs: DataFrame, bits: Broadcast, threshold: int = THRESHOLD) -> DataFrame:
    """lang, phrase, size and f of every run that occurs ``threshold`` times or more in its
    language, counted exactly; and a row of size 0 per language with all its words."""

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for runs, langs in stretches(batch):
                told = passes(bits.value, runs.keys)
                _, first, times = np.unique(runs.keys[told], return_index=True, return_counts=True)
                first = np.flatnonzero(told)[first]
                spelt = runs.spell(first)
                named, own = np.unique(np.array(langs, object), return_inverse=True)
                of_text = own[runs.text]
                totals = np.bincount(of_text, minlength=len(named))
                every = pa.array(named, pa.string())
                lang = every.take(pa.array(of_text[runs.first[first]]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([lang, every]),
                        pa.array([*spelt, *[b""] * len(named)], pa.binary()).cast(pa.string()),
                        pa.array(np.concatenate([runs.size[first], np.zeros(len(named), np.int64)])),
                        pa.array(np.concatenate([times, totals])),
                    ],
                    ["lang", "phrase", "size", "f"],
                )

    counted = _read(docs).mapInArrow(tell, "lang string, phrase string, size long, f long")
    summed = counted.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    return summed.filter((F.col("f") >= threshold) | (F.col("size") == 0))


def collocations(docs: DataFrame, threshold: int = THRESHOLD, best: int = BEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two or three words.

    A null language is ``und``, a null text empty; texts that repeat count as often as they
    are there; without a candidate a language has no row, and no rows give none.  ``docs``
    may have any other columns.  A very long text is worked on in stretches, cut where a
    piece ends; a single piece (no ``.,;:!?`` or line end in it) is never cut.  Ties rank by
    count, then by the phrase's bytes.
    """
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(frequent_filter(docs, threshold))
    counts = written(run_counts(docs, bits, threshold), "frequent-runs")
    words = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    found = counts.filter("size > 0")
    phrases = found.filter("size > 1").withColumnRenamed("f", "a")
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1L, size - 1)")))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', CAST(k AS INT))"))
    cuts = cuts.withColumn("right", F.expr("substr(phrase, length(left) + 2)"))
    # A part is at least as frequent as its phrase, so it is there.  One row per part: a hot
    # part's phrases are what adaptive execution may split.
    parts = found.select("lang", "phrase", "f")
    of_left = parts.toDF("lang", "left", "l")
    of_right = parts.toDF("lang", "right", "r")
    cuts = cuts.join(of_left, ["lang", "left"]).join(of_right, ["lang", "right"])
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(
        F.min(F.struct(_score().alias("score"), "k", "l", "r")).alias("cut")
    )
    scored = scored.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")
    inner = phrases.filter("size = 3").select(
        "lang",
        F.explode(F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)))
        .alias("phrase"),
        F.col("a").alias("longer"),
    )
    longest = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(longest, ["lang", "phrase"], "left").filter(
        F.coalesce(F.col("longer") * 100 < F.col("a") * COVERED, F.lit(True))
    )
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    in_part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    kept = kept.withColumn("place", in_part).filter(F.col("place") <= best)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    kept = kept.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= best)
    return kept.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _score():
    """floor(1000000 * a * a / (l * r)) in whole numbers of up to 38 digits."""
    return F.expr(
        "(CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0)) * CAST(1000000 AS DECIMAL(7,0)))"
        " div (CAST(l AS DECIMAL(16,0)) * CAST(r AS DECIMAL(16,0)))"
    )
