"""Removal of repeated byte strings: bounds by anchors, then a merge of shard BWTs.

A window is a string of ``length`` bytes inside one text.  Each window has an anchor, its
smallest hashed gram, so equal windows have equal anchors at equal places.  Windows of
one anchor are cut into blocks.  All windows of a block contain the block's core; a core
that occurs once rules the block out, and a whole block that occurs twice is repeated.
What is left, around the edges of repeats, goes block by block of ``FINE`` windows to
tasks by its core: there the core counts as one symbol between the bytes beside it, the
strings are cut into shards with a Burrows-Wheeler transform each, and the transforms
are merged by refining their interleave.  Suffixes that share a whole window of symbols
are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.bwt_merge import END, interleave, merged_suffixes, transformed
from skyledger.llm.common import pieces, tasks, texts, utf8
from skyledger.llm.hashing import Stretches, mix
from skyledger.shared import written

#: Bytes of a repeated string, and of the grams that anchor it.
LENGTH = 400
GRAM = 20
#: Windows of a block in the first round and in the second.
COARSE, FINE = 128, 32
#: Distinct strings with one core that a task merges; more are settled window by window.
MERGED = 2000
#: Strings of all cores in a task, about, and of a shard of them.
TASK, SHARD = 8000, 2000
#: Bytes of text whose windows are looked at together.
STRETCH = 1 << 19

_PLACE_BITS = 28


def anchored(data: np.ndarray, starts: np.ndarray, length: int, gram: int, hashed: Stretches):
    """Anchor, first and last window of every run of windows with one anchor, and its text."""
    n, none = len(data), np.empty(0, np.int64)
    if n < length:
        return none, none, none, none
    if n >> _PLACE_BITS:
        raise ValueError("a text of 2**28 bytes or more")
    at = np.arange(n - gram + 1)
    # The place in the low bits lets the leftmost of equal grams win.
    value = hashed.hash(at, at + gram) >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)
    value |= at.astype(np.uint64)
    width = length - gram + 1
    padded = np.full(-(-len(value) // width) * width, np.iinfo(np.uint64).max)
    padded[: len(value)] = value
    rows = padded.reshape(-1, width)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    since = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - length + 1
    anchor = np.minimum(since[:m], upto[width - 1 : width - 1 + m])
    anchor = (anchor & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[:m]
    inside = np.arange(m) + length <= starts[text + 1]
    window = np.flatnonzero(inside)
    if not len(window):
        return none, none, none, none
    anchor, text = anchor[window], text[window]
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    return anchor[first], window[first], window[last], text[first]


_ITEM = "core long, outer long, key long, start long, low long, high long"


def _coarse(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Blocks of ``COARSE`` windows: hashes of their cores and of their whole stretch, the
    text's key, where in it they start, and which windows (distances to the anchor)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, STRETCH):
                data, starts = utf8(piece.column("text"))
                hashed = Stretches(data)
                anchor, first, last, text = anchored(data, starts, length, gram, hashed)
                near, far = anchor - last, anchor - first
                blocks = far // COARSE - near // COARSE + 1
                which = np.repeat(np.arange(len(anchor)), blocks)
                k = np.arange(len(which)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                k += near[which] // COARSE
                low, high = np.maximum(near[which], COARSE * k), np.minimum(far[which], COARSE * k + COARSE - 1)
                x = anchor[which]
                core = hashed.hash(x - COARSE * k, x - (COARSE * k + COARSE - 1) + length)
                outer = hashed.hash(x - high, x - low + length)
                low, high = low - COARSE * k, high - COARSE * k
                start = x - (high + COARSE * k) - starts[text[which]]
                core = mix(core ^ mix(k.astype(np.uint64)))
                outer = mix(outer ^ mix(core + (low * COARSE + high).astype(np.uint64)))
                key = piece.column("key").to_numpy()[text[which]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (core.view(np.int64), outer.view(np.int64), key, start, low, high)],
                    ["core", "outer", "key", "start", "low", "high"],
                )

    return docs.mapInArrow(run, _ITEM)


def _repeated(items: DataFrame, column: str) -> DataFrame:
    """Values of a hash column that several items have."""
    return items.groupBy(column).agg(F.count("*").alias("times")).filter("times > 1")


def _settle(items: DataFrame, name: str) -> DataFrame:
    """Items whose core occurs again, with how often their whole stretch occurs."""
    shared = items.join(_repeated(items, "core").select("core"), "core")
    shared = written(shared, f"{name}-shared")
    again = _repeated(shared, "outer").select("outer", "times")
    return written(
        shared.join(again, "outer", "left").fillna(1, ["times"]), f"{name}-settled"
    )


_FINE = f"{_ITEM}, times long, before binary, after binary"


def _fine(contents: DataFrame, length: int) -> DataFrame:
    """Blocks of ``FINE`` windows of the stretches, with the bytes on both sides of the core."""
    names = ["core", "outer", "key", "start", "low", "high", "times"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                yield blocks(batch.slice(at, 2000))

    def blocks(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, starts = utf8(batch.column("bytes"))
        core, key, start, low, high, times = (
            batch.column(c).to_numpy() for c in ("core", "key", "start", "low", "high", "times")
        )
        count = high // FINE - low // FINE + 1
        which = np.repeat(np.arange(len(low)), count)
        k = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + low[which] // FINE
        a, b = FINE * k, FINE * k + FINE - 1
        lo, hi = np.maximum(low[which], a), np.minimum(high[which], b)
        anchor = starts[:-1][which] + high[which]
        hashed = Stretches(data)
        parent = core.view(np.uint64)[which] + k.astype(np.uint64)
        inner = mix(hashed.hash(anchor - a, anchor - b + length) ^ mix(parent))
        outer = hashed.hash(anchor - hi, anchor - lo + length)
        outer = mix(outer ^ mix(inner + (lo * COARSE + hi).astype(np.uint64)))
        raw = data.tobytes()
        before = [raw[i:j] for i, j in zip(anchor - hi, anchor - a, strict=True)]
        after = [raw[i:j] for i, j in zip(anchor - b + length, anchor - lo + length, strict=True)]
        columns = (
            inner.view(np.int64), outer.view(np.int64), key[which],
            start[which] + high[which] - hi, lo - a, hi - a, times[which],
        )
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, columns), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
            [*names, "before", "after"],
        )

    return contents.mapInArrow(run, _FINE)


def _shard(batch: pa.RecordBatch, cores: dict[int, int]):
    """The strings of a batch: bytes before the core, the core as a symbol, bytes after."""
    before, after = batch.column("before").to_pylist(), batch.column("after").to_pylist()
    parts = []
    for b, a, core in zip(before, after, batch.column("core").to_pylist(), strict=True):
        parts += [
            np.frombuffer(b, np.uint8) + np.int32(1),
            np.array([257 + cores.setdefault(core, len(cores))], np.int32),
            np.frombuffer(a, np.uint8) + np.int32(1),
            np.array([END], np.int32),
        ]
    return transformed(np.concatenate(parts).astype(np.int32))


def _merge(length: int):
    """Spans of repeated windows among the strings of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b.slice(k, SHARD) for b in batches for k in range(0, b.num_rows, SHARD)]
        if not held:
            return
        cores: dict[int, int] = {}
        shards = [_shard(b, cores) for b in held]
        of, prefix = interleave(shards, FINE)
        place = merged_suffixes(shards, of)
        symbols = np.concatenate([s.symbols for s in shards])
        strings = np.cumsum(symbols == END)
        string = strings[place] - (symbols[place] == END)
        table = pa.Table.from_batches(held)
        high, low, times = (table.column(c).to_numpy() for c in ("high", "low", "times"))
        begin = np.append(0, np.flatnonzero(symbols == END)[:-1] + 1)
        # A string's windows start at its first symbols, as many as it owns.
        offset = place - begin[string]
        window = offset <= high[string] - low[string]
        block = np.cumsum(prefix < FINE)
        weight = np.bincount(block[window], times[string[window]])
        hit = np.flatnonzero(window)
        hit = hit[(weight[block[hit]] > 1) & (times[string[hit]] == 1)]
        key, start = (table.column(c).to_numpy()[string[hit]] for c in ("key", "start"))
        start = start + offset[hit]
        yield _spans(key, start, start + length)

    return run


def _spans(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Unions of overlapping spans."""
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], end[order]
    if len(key):
        reach = end.copy()
        new = np.ones(len(key), bool)
        for k in range(1, len(key)):
            if key[k] == key[k - 1] and start[k] <= reach[k - 1]:
                new[k] = False
                reach[k] = max(end[k], reach[k - 1])
        first = np.flatnonzero(new)
        key, start, end = key[first], start[first], reach[np.append(first[1:], len(new)) - 1]
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
        ["key", "start", "end"],
    )


_SPAN = "key long, start long, end long"


def _single(fine: DataFrame, length: int) -> DataFrame:
    """Every window of the blocks by itself, as core, outer (both its hash), key, start, times."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                # With the core as what it is, a window is the bytes before and after it.
                both = np.frombuffer(row["before"] + row["after"], np.uint8)
                at = np.arange(row["high"] - row["low"] + 1)
                hashes = Stretches(both).hash(at, at + FINE - 1)
                core = np.array([row["core"]]).view(np.uint64)
                hashes = mix(hashes ^ mix(core + (row["high"] - at).astype(np.uint64)))
                out += [(int(h), row["key"], row["start"] + int(k), row["times"])
                        for k, h in zip(at, hashes.view(np.int64), strict=True)]
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["win", "key", "start", "times"]
            )

    windows = written(fine.mapInArrow(run, "win long, key long, start long, times long"), "windows")
    again = windows.groupBy("win").agg(F.sum("times").alias("all")).filter("all > 1")
    return windows.filter("times = 1").join(again.select("win"), "win").select(
        "key", "start", (F.col("start") + length).alias("end")
    )


def _span(items: DataFrame, length: int) -> DataFrame:
    end = F.col("start") + F.col("high") - F.col("low") + length
    return items.select("key", "start", end.alias("end"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """key, start and end of stretches that cover all repeated windows; they may overlap."""
    settled = _settle(_coarse(docs, length, gram), "coarse")
    whole = _span(settled.filter("times > 1"), length)
    # Open blocks, and one copy of each settled block with the same core.
    open_cores = settled.filter("times = 1").select("core").distinct()
    open_cores = written(open_cores, "open-cores")
    copies = settled.filter("times > 1").dropDuplicates(["outer"])
    wanted = settled.filter("times = 1").select(_ROW).unionByName(
        copies.join(open_cores, "core", "left_semi").select(_ROW)
    )
    fine = _fine(_contents(docs, written(wanted, "wanted"), length), length)
    fine = written(fine, "fine")
    cores = fine.groupBy("core").agg(F.count("*").alias("strings"), F.sum("times").alias("all"))
    cores = cores.filter("all > 1")
    outers = fine.groupBy("core", "outer").agg(
        F.sum("times").alias("times"), F.min_by(F.struct("key", "start", "low", "high", "before", "after"), F.struct("key", "start")).alias("one")
    )
    # Strings that occur again are repeated as a whole; one of each stays to be met.
    twice = outers.filter("times > 1").select("core", "outer")
    whole_fine = _span(fine.filter("times = 1").join(twice, ["core", "outer"], "left_semi"), length)
    strings = outers.join(cores.select("core", "strings"), "core").select(
        "core", "times", "strings", "one.*"
    )
    strings = written(strings, "strings")
    few, many = strings.filter(f"strings <= {MERGED}"), strings.filter(f"strings > {MERGED}")
    parts = max(tasks(docs.sparkSession), -(-few.count() // TASK))
    merged = few.repartition(parts, "core").mapInArrow(_merge(length), _SPAN)
    return (
        whole.unionByName(whole_fine).unionByName(merged).unionByName(_single(many, length))
    )


_ROW = ["core", "key", "start", "low", "high", "times"]


def _contents(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted rows with the bytes of their stretches."""
    slots = wanted.groupBy("key").agg(F.collect_list(F.struct(*(c for c in _ROW if c != "key"))).alias("slots"))

    names = ["core", "start", "low", "high", "times"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for key, text, slots in zip(keys, batch.column("text"), batch.column("slots"), strict=True):
                data = text.as_py().encode()
                for r in slots.as_py():
                    end = r["start"] + r["high"] - r["low"] + length
                    held.append((*(r[c] for c in names), key, data[r["start"] : end]))
                if len(held) > 2000:
                    yield cut(held)
                    held = []
        if held:
            yield cut(held)

    def cut(held: list[tuple]) -> pa.RecordBatch:
        *numbers, stretches = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in numbers), pa.array(stretches, pa.binary())],
            [*names, "key", "bytes"],
        )

    # Rows that repeat an id and a text have one key: their slots are cut once.
    schema = "core long, start long, low long, high long, times long, key long, bytes binary"
    return docs.join(slots, "key").select("key", "text", "slots").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (binary) of every document.

    Every byte of a string of ``length`` bytes that also starts anywhere else goes; strings
    never cross documents and are judged on the input.  Null and empty texts have no bytes;
    repeated rows are documents of their own, so a long one loses all its bytes.  No rows
    give no rows; other columns are left.  Strings are compared by 64-bit hashes.
    """
    read = texts(docs).withColumn("key", F.xxhash64("doc_id", "text"))
    spans = written(repeated_spans(read.select("key", "text"), length, gram), "spans")
    merged = spans.distinct().groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("gone"))

    kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = zip(part.column("text"), part.column("gone"), strict=True)
                columns = zip(*(cut(text.as_py().encode(), gone.as_py() or []) for text, gone in rows), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                    ["doc_id", *names],
                )

    def cut(data: bytes, gone: list[dict]) -> tuple:
        kept, at, runs, end = [], 0, 0, -1
        for first, last in sorted((s["start"], s["end"]) for s in gone):
            if first > end:
                runs += 1
                kept.append(data[at:first])
            end = at = max(end, last)
        left = b"".join([*kept, data[at:]])
        return len(data), len(data) - len(left), runs, hashlib.sha256(left).hexdigest(), left

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return read.join(merged, "key", "left").select("doc_id", "text", "gone").mapInArrow(run, schema)
