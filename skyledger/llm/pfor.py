"""Token ids in binary files of patched frame-of-reference blocks.

A file holds whole documents, in ascending order of ids over all files, and has

* a header of big-endian numbers (``HEADER``): mark, ids a block, number of its part, ids of
  the part before it, ids, documents, bytes of block data;
* the documents: their ids (8 bytes each), whether each id is null (1 byte each), and where
  each one's ids start, ends included (8 bytes each, one more than documents);
* where each block starts in the block data (8 bytes each), then the block data.

A block is its least id (4 bytes), a width (1) and a number of exceptions (2); then the lowest
``width`` bits of every id less the least one; then the exceptions' places (1 byte each) and
their ids less the least one (4 each).  The width is the number of bits that ``PERCENTILE`` of
the block's ids need.  These numbers are little-endian.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import tasks, texts
from skyledger.llm.tokens import RANKS, encode
from skyledger.shared import scratch_table

END_ID = 2
BLOCK = 256
PERCENTILE = 0.9
#: A file is closed at so many ids; one document is never cut.
FILE_IDS = 8 << 20
#: Bytes of text that one task encodes, about.
TASK_BYTES = 64 << 20
#: Blocks packed or unpacked at a time.
_AT_ONCE = 2048

MARK = b"PFR1"
HEADER = struct.Struct(">4sIQQQQQ")
_BLOCK_HEAD = 7


def pack_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each block starts (and the end), and the block data."""
    starts, data, end = [np.zeros(1, np.int64)], [], 0
    for first in range(0, len(ids), BLOCK * _AT_ONCE):
        sizes, packed = _pack(ids[first : first + BLOCK * _AT_ONCE])
        starts.append(end + np.cumsum(sizes))
        end += len(packed)
        data.append(packed)
    return np.concatenate(starts), np.concatenate(data) if data else np.empty(0, np.uint8)


def _pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    blocks = -(-len(ids) // BLOCK)
    # The last block is filled up with the last id.
    rows = np.full(blocks * BLOCK, ids[-1], np.uint32)
    rows[: len(ids)] = ids
    rows = rows.reshape(blocks, BLOCK)
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    bits = np.frexp(rest.astype(np.float64))[1].astype(np.uint8)
    place = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = np.partition(bits, place, axis=1)[:, place].astype(np.int64)
    block, position = np.nonzero(bits > width[:, None])
    exceptions = np.bincount(block, minlength=blocks)
    sizes = _BLOCK_HEAD + width * (BLOCK // 8) + 5 * exceptions
    starts = np.cumsum(sizes) - sizes
    data = np.empty(int(sizes.sum()), np.uint8)
    _scatter(data, starts, least.astype("<u4"))
    data[starts + 4] = width
    _scatter(data, starts + 5, exceptions.astype("<u2"))
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        low = np.unpackbits(
            rest[at].astype("<u4").view(np.uint8).reshape(len(at), BLOCK, 4), axis=2, bitorder="little"
        )[:, :, :w]
        packed = np.packbits(low.reshape(len(at), BLOCK * w), axis=1, bitorder="little")
        data[(starts[at] + _BLOCK_HEAD)[:, None] + np.arange(packed.shape[1])] = packed
    nth = np.arange(len(block)) - (np.cumsum(exceptions) - exceptions)[block]
    tail = (starts + _BLOCK_HEAD + width * (BLOCK // 8))[block]
    data[tail + nth] = position
    _scatter(data, tail + exceptions[block] + 4 * nth, rest[block, position].astype("<u4"))
    return sizes, data


def _scatter(data: np.ndarray, at: np.ndarray, numbers: np.ndarray) -> None:
    for k, column in enumerate(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T):
        data[at + k] = column


def _gather(data: np.ndarray, at: np.ndarray, kind: str) -> np.ndarray:
    held = np.stack([data[at + k] for k in range(np.dtype(kind).itemsize)], axis=-1)
    return np.ascontiguousarray(held).view(kind).reshape(len(at))


def unpack_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All ids of the blocks that start at ``starts``; the last block's filling is kept."""
    parts = [_unpack(data, starts[k : k + _AT_ONCE]) for k in range(0, len(starts), _AT_ONCE)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def _unpack(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    least = _gather(data, starts, "<u4")
    width = data[starts + 4].astype(np.int64)
    exceptions = _gather(data, starts + 5, "<u2").astype(np.int64)
    rest = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        packed = data[(starts[at] + _BLOCK_HEAD)[:, None] + np.arange(w * BLOCK // 8)]
        bits = np.zeros((len(at), BLOCK, 32), np.uint8)
        bits[:, :, :w] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(at), BLOCK, w)
        rest[at] = np.packbits(bits, axis=2, bitorder="little").view("<u4")[:, :, 0]
    block = np.repeat(np.arange(len(starts)), exceptions)
    nth = np.arange(len(block)) - (np.cumsum(exceptions) - exceptions)[block]
    tail = (starts + _BLOCK_HEAD + width * (BLOCK // 8))[block]
    if len(block):
        rest[block, data[tail + nth]] = _gather(data, tail + exceptions[block] + 4 * nth, "<u4")
    return (rest + least[:, None]).reshape(-1)


def file_bytes(part: int, before: int, doc_ids: list[int | None], rows: list[np.ndarray]) -> bytes:
    """One file of documents and their ids."""
    ids = np.concatenate([np.empty(0, np.uint32), *rows]).astype(np.uint32)
    starts, data = pack_blocks(ids)
    ends = np.cumsum([0, *map(len, rows)])
    return b"".join(
        [
            HEADER.pack(MARK, BLOCK, part, before, len(ids), len(rows), len(data)),
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            bytes(x is None for x in doc_ids),
            ends.astype("<i8").tobytes(),
            starts[:-1].astype("<i8").tobytes(),
            data.tobytes(),
        ]
    )


class IdFile:
    """The documents of one file; ids are unpacked when they are asked for."""

    def __init__(self, content: bytes):
        mark, block, self.part, self.before, self.n_ids, self.n_docs, size = HEADER.unpack_from(content)
        if mark != MARK or block != BLOCK:
            raise ValueError("not a file of packed token ids")
        at = HEADER.size
        values = np.frombuffer(content, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        null = np.frombuffer(content, bool, self.n_docs, at)
        self.doc_ids = [None if gone else x for x, gone in zip(values.tolist(), null.tolist(), strict=True)]
        at += self.n_docs
        self.starts = np.frombuffer(content, "<i8", self.n_docs + 1, at)
        at += 8 * (self.n_docs + 1)
        blocks = -(-self.n_ids // BLOCK)
        self._blocks = np.frombuffer(content, "<i8", blocks, at)
        self._data = np.frombuffer(content, np.uint8, size, at + 8 * blocks)

    def ids(self, first: int, end: int) -> np.ndarray:
        """Ids from place ``first`` to ``end`` of the file; no other block is unpacked."""
        from_block = first // BLOCK
        held = unpack_blocks(self._data, self._blocks[from_block : -(-end // BLOCK)])
        return held[first - from_block * BLOCK : end - from_block * BLOCK]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))

    def documents(self) -> Iterator[np.ndarray]:
        """Ids of every document, unpacking about a million ids at a time."""
        k = 0
        while k < self.n_docs:
            last = int(np.searchsorted(self.starts, self.starts[k] + (1 << 20), "right")) - 1
            last = min(max(last, k + 1), self.n_docs)
            first = int(self.starts[k])
            held = self.ids(first, int(self.starts[last]))
            for j in range(k, last):
                yield held[self.starts[j] - first : self.starts[j + 1] - first]
            k = last


def write_ids(docs: DataFrame, path: str, ranks: str = RANKS, end_id: int = END_ID) -> None:
    """Encode whole texts, ``end_id`` after each, into files below ``path``.

    Rows are in ascending order of doc_id, nulls first; rows of one id keep the order of the
    input.  A null or empty text is its end id alone; no rows give a file without documents
    or none.  Other columns are left.  Ids are dealt into ranges, also within one id, so no
    task gets more than its share.  ``path.index`` gets how many ids come before each part.
    """
    spark = docs.sparkSession
    read = texts(docs).withColumn("row", F.monotonically_increasing_id())
    size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = (F.col("doc_id").asc_nulls_first(), F.col("row").asc())
    dealt = read.repartitionByRange(max(tasks(spark), size // TASK_BYTES + 1), *order)
    dealt = dealt.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], np.uint32)
        part, before, held, ids, rows = 0, 0, 0, [], []

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([file_bytes(part, before, ids, rows)], pa.binary())], ["content"]
            )

        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                rows.append(np.concatenate([encode(text.as_py(), ranks).astype(np.uint32), end]))
                ids.append(doc_id)
                held += len(rows[-1])
                if held >= FILE_IDS:
                    yield closed()
                    before, held, ids, rows = before + held, 0, [], []
        if rows:
            yield closed()

    # A text file of one row is the row's bytes and a line end: Spark commits it as any
    # other output, on whatever file system the path is.
    files = dealt.mapInArrow(pack, "content binary").select(F.col("content").cast("string"))
    files.write.mode("overwrite").option("compression", "none").option("maxRecordsPerFile", 1).text(path)
    head = {name: _header(8 + 8 * k) for k, name in enumerate(("part", "before", "ids"))}
    heads = _files(spark, path).select(*(value.alias(name) for name, value in head.items()))
    parts = heads.groupBy("part").agg(F.max(F.col("before") + F.col("ids")).alias("ids"))
    # One row per task of the write.
    running = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    index = parts.select("part", F.coalesce(F.sum("ids").over(running), F.lit(0)).alias("ids_before"))
    index.write.mode("overwrite").parquet(_index_path(path))


def _header(at: int):
    return F.conv(F.hex(F.substring("content", at + 1, 8)), 16, 10).cast("long")


def _index_path(path: str) -> str:
    return f"{path.rstrip('/')}.index"


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.filter(F.col("length") > HEADER.size).select("content")


def _read(
    spark: SparkSession, path: str, column: str, kind: pa.DataType, sql: str, tell: Callable
) -> DataFrame:
    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                file = IdFile(content.as_py())
                told, first = [], 0
                # A few thousand documents a batch, so that their ids stay bounded.
                for k, ids in enumerate(file.documents(), 1):
                    told.append(tell(ids))
                    if len(told) == 2000 or k == file.n_docs:
                        starts = file.starts[first : k + 1]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([file.part] * (k - first), pa.int64()),
                                pa.array(file.doc_ids[first:k], pa.int64()),
                                pa.array(file.before + starts[:-1]),
                                pa.array(np.diff(starts)),
                                pa.array(told, kind),
                            ],
                            ["part", "doc_id", "at", "n_tokens", column],
                        )
                        told, first = [], k

    rows = _files(spark, path).mapInArrow(
        unpack, f"part long, doc_id long, at long, n_tokens long, {column} {sql}"
    )
    # One row per task of the write.
    index = spark.read.schema("part long, ids_before long").parquet(_index_path(path))
    start = (F.col("ids_before") + F.col("at")).alias("start")
    return rows.join(index, "part").select("doc_id", start, "n_tokens", column)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (as little-endian
    unsigned 32-bit integers) of every document below ``path``."""
    return _read(spark, path, "ids", pa.binary(), "binary", lambda ids: ids.astype("<u4").tobytes())


def digest_ids(docs: DataFrame, ranks: str = RANKS, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from its file."""
    spark = docs.sparkSession
    path = scratch_table(spark, "token-ids")
    write_ids(docs, path, ranks, end_id)
    return _read(
        spark, path, "ids_crc32", pa.int64(), "long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes())
    )
