from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapewatch.llm import byte_bpe
from tapewatch.llm.byte_bpe import codec, decode_range, merge, split_long, split_texts, transitions, with_decoded, with_tokens
from tapewatch.llm.support import slices

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE = regex.compile(public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ALPHABET = "aZé'strevmld  \n\t\r\x85\xa0　09½Ⅷ.,!漢🙂́_​'"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=40), max_size=6))
def test_pieces(texts):
    assert list(split_texts(texts)) == [PIECE.findall(text) for text in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(ALPHABET, max_size=60), st.integers(1, 9))
def test_pieces_of_a_text_in_parts(text, part):
    assert [piece for pieces in split_long(text, part) for piece in pieces] == PIECE.findall(text)


def test_all_contractions():
    tails = ["s", "t", "re", "ve", "m", "ll", "d", "l", "r", "S", "RE", "", "'", "'s"]
    texts = [f"{head}'{tail}{end}" for head in ("", "a", " ", "  ", "!", "1", "\n", "'s", " '") for tail in tails for end in ("", "x", " ", "1", "!", "\n")]
    assert list(split_texts(texts)) == [PIECE.findall(text) for text in texts]


def test_scan_equals_step_by_step():
    random.seed(1)
    table = transitions()
    assert table.count < 256
    for size in (0, 1, 63, 64, 65, 1000, 20_000, 40_001):
        functions = np.array([random.randrange(table.count) for _ in range(size)], dtype=np.uint8)
        total, expected = 0, []
        for function in functions:
            total = table.compose[total, function]
            expected.append(total)
        assert table.scan(functions).tolist() == expected


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=80))
def test_merges(library, piece):
    assert merge(piece, library._mergeable_ranks) == library._core_bpe.encode_single_piece(piece)


def test_like_the_library(library):
    random.seed(7)
    points = [*range(0x20, 0x250), *range(0x370, 0x400), 0x2028, 0x3000, *range(0x4E00, 0x4E40), 0x1F642, 0x10FFFF]
    texts = ["".join(chr(random.choice(points)) for _ in range(300)) for _ in range(200)]
    texts += ["the cat's " * 70_000, "a" * 600_000, " " * 9000, "\n" * 9000, "", "x"]
    own = codec(PATH)
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_every_code_point(library):
    text = "".join(f"a{chr(c)} " for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    ids = next(codec(PATH).encode([text]))
    assert np.array_equal(np.frombuffer(ids, "<u4"), np.array(library.encode_ordinary(text), dtype="<u4"))


def test_odd_documents(library, odd_documents):
    frame = with_tokens(odd_documents.withColumn("old", F.col("text")), PATH)
    assert frame.columns == [*[c for c in odd_documents.columns if c != "text"], "old", "ids", "offsets"]
    rows = with_decoded(frame, PATH).collect()
    assert len(rows) == odd_documents.count()
    for row in rows:
        data = (row.old or "").encode()
        ids = np.frombuffer(row.ids, "<u4")
        assert ids.tolist() == library.encode_ordinary(row.old or "")
        assert bytes(row.decoded) == data
        offsets = np.frombuffer(row.offsets, "<u4")
        assert len(offsets) == len(ids) and (not len(ids) or offsets[0] == 0)
        first, last = len(ids) // 3, 2 * len(ids) // 3
        begin, part = decode_range(row.ids, row.offsets, PATH, first, last)
        assert data[begin : begin + len(part)] == part
    both = with_tokens(odd_documents.withColumn("old", F.col("text")), PATH, offsets=None, decoded="back")
    assert all(bytes(row.back) == (row.old or "").encode() for row in both.collect())
    with pytest.raises(ValueError, match="ids"):
        with_tokens(frame.withColumn("text", F.lit("")), PATH)
    with pytest.raises(ValueError, match="ids"):
        with_decoded(frame, PATH, decoded="ids")


def test_no_documents(no_documents):
    assert with_decoded(with_tokens(no_documents, PATH), PATH).collect() == []


def test_slices_keep_all_rows():
    texts = ["a" * n for n in (0, 5, 30, 1, 1, 0, 12, 3)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    parts = list(slices(batch, 0, 10))
    assert [x for part in parts for x in part.column(0).to_pylist()] == texts
    assert all(part.num_rows == 1 or sum(len(x or "") for x in part.column(0).to_pylist()) <= 10 for part in parts)
    assert list(slices(batch.slice(0, 0), 0)) == []


def test_memory_of_pieces_is_bounded(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 10)
    own = byte_bpe.Codec(PATH)
    text = " ".join(str(i * 7919) + chr(97 + i % 26) for i in range(500))
    ids = next(own.encode([text]))
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text) and len(own.merges) <= 11


def test_registered_query(spark, library):
    from tapewatch.llm.queries import op7_byte_bpe

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = op7_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = np.array(library.encode_ordinary(docs[row.doc_id]), dtype="<u4")
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()
