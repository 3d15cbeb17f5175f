from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyledger.llm import pfor
from skyledger.llm.queries import QUERIES
from skyledger.llm.tokens import encode
from tests.llm.corpus import AWKWARD, frame

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def exact(library, rows):
    """Rows in order -> (doc_id, start, n_tokens, crc)."""
    told, start = [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        told.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return told


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(0, 300)), max_size=1200),
    st.integers(0, 5),
)
def test_blocks_round_trip(numbers, spread):
    ids = np.array([x >> (4 * spread) for x in numbers], np.uint32)
    starts, data = pfor.pack_blocks(ids)
    assert len(data) == starts[-1]
    assert np.array_equal(pfor.unpack_blocks(data, starts[:-1])[: len(ids)], ids)


def test_outliers_are_exceptions():
    ids = np.full(256, 7, np.uint32)
    ids[::20] = 4_000_000_000
    starts, data = pfor.pack_blocks(ids)
    # No bits for the common id, five bytes for each of thirteen others.
    assert starts.tolist() == [0, 7 + 5 * 13]
    assert np.array_equal(pfor.unpack_blocks(data, starts[:-1]), ids)


def test_many_blocks_and_any_document(monkeypatch):
    monkeypatch.setattr(pfor, "_AT_ONCE", 3)
    draw = np.random.default_rng(5)
    rows = [draw.integers(0, 50257, n).astype(np.uint32) for n in (0, 1, 255, 256, 257, 5000, 3)]
    file = pfor.IdFile(pfor.file_bytes(4, 99, [3, None, 5, 6, 7, 8, 9], rows) + b"\n")
    assert (file.part, file.before, file.n_ids) == (4, 99, sum(map(len, rows)))
    assert file.doc_ids == [3, None, 5, 6, 7, 8, 9]
    assert all(np.array_equal(a, b) for a, b in zip(file.documents(), rows, strict=True))
    assert all(np.array_equal(file.document(k), row) for k, row in enumerate(rows))
    with pytest.raises(ValueError):
        pfor.IdFile(b"XXXX" + bytes(200))


def test_whole_table_against_the_library(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    found = QUERIES["op12_pfor"](spark, SMALL)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in found.collect()) == exact(library, rows)


def test_awkward_rows(spark, library, monkeypatch):
    monkeypatch.setattr(pfor, "FILE_IDS", 3000)
    rows = [*AWKWARD, (20, "a <|endoftext|> b"), (21, "x" * 3000), (22, "\x00\n\x00")]
    found = sorted(
        (tuple(r) for r in pfor.digest_ids(frame(spark, rows)).collect()), key=lambda r: r[1]
    )
    # Rows of one id keep some order of the input.
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    assert [r[0] for r in found] == [rows[k][0] for k in order]
    starts = [r[1] for r in found]
    assert starts == np.cumsum([0, *(r[2] for r in found[:-1])]).tolist()
    expected = sorted((str(a), n, crc) for a, _, n, crc in exact(library, rows))
    assert sorted((str(a), n, crc) for a, _, n, crc in found) == expected


def test_ids_read_back(spark, tmp_path, library):
    rows = [(3, "three words here"), (1, None), (2, "zwei Wörter")]
    path = str(tmp_path / "ids")
    pfor.write_ids(frame(spark, rows), path)
    read = pfor.read_ids(spark, path).orderBy("start").collect()
    texts = [library.decode(np.frombuffer(r["ids"], "<u4").tolist()[:-1]) for r in read]
    assert [(r["doc_id"], t) for r, t in zip(read, texts, strict=True)] == [
        (1, ""), (2, "zwei Wörter"), (3, "three words here"),
    ]


def test_no_rows(spark):
    found = pfor.digest_ids(spark.createDataFrame([], "doc_id long, text string"))
    assert found.collect() == []


@pytest.mark.parametrize(
    "text",
    [" " * 2_000_000, "\n" * 1_200_000 + "x", "a" + "\t" * 1_100_000 + " b <|endoftext|>" + " " * 1_050_000
     + "<|endoftext|>c", "　" * 1_001_000 + "é", "q" * 300_000],
    ids=["spaces", "line ends", "marks", "wide", "letters"],
)
def test_long_runs_as_the_library_has_them(library, text):
    assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
