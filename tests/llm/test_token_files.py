from __future__ import annotations

import struct
import zlib
from pathlib import Path

import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tapewatch.llm import token_files
from tapewatch.llm.token_files import read_token_files, seek_table, with_starts, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
    return struct.pack(f"<{len(ids)}I", *ids)


def expected(library, rows):
    """(doc_id, ids) in ascending order of ids; rows without an id first."""
    return sorted(((i is not None, i or 0), ids_of(library, text)) for i, text in rows)


def test_odd_documents(spark, library, odd_documents, tmp_path):
    write_token_files(odd_documents, str(tmp_path / "f"), PATH, 2)
    rows = with_starts(read_token_files(spark, str(tmp_path / "f"))).collect()
    wanted = expected(library, [(r.doc_id, r.text) for r in odd_documents.collect()])
    found = sorted(((r.doc_id is not None, r.doc_id or 0), bytes(r.ids)) for r in rows)
    assert found == wanted
    rows.sort(key=lambda r: (r.file, r.ordinal))
    assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == [key for key, _ in wanted]
    start = 0
    for row in rows:
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(row.ids) // 4, zlib.crc32(row.ids))
        start += row.n_tokens


def test_no_documents(spark, no_documents, tmp_path):
    write_token_files(no_documents, str(tmp_path / "f"), PATH, 2)
    assert with_starts(read_token_files(spark, str(tmp_path / "f"))).collect() == []


def test_long_documents_span_frames(spark, library, monkeypatch, tmp_path):
    rows = [(i, f"word{i} " * (50 * i)) for i in range(30)]
    writer = token_files.FileWriter()
    monkeypatch.setattr(token_files, "FRAME_TOKENS", 100)
    monkeypatch.setattr(token_files, "RECORD_BYTES", 500)
    encoder = token_files.WordEncoder(PATH, 2)
    records = [r for i, text in rows for r in writer.add(i, encoder.encode(text))]
    content = b"".join(r + token_files.GAP_BYTES for r in [*records, *writer.finish()])
    joined: dict[int, bytes] = {}
    for doc_id, first, ids in token_files.frames_of(content):
        assert first == (doc_id not in joined)
        joined[doc_id] = joined.get(doc_id, b"") + ids
    assert joined == {i: ids_of(library, text) for i, text in rows}
    assert len(seek_table(content)) > len(rows)


def test_file_format(spark, library, tmp_path):
    """Any zstandard reader sees one stream; wanted documents only are decompressed; damage is seen."""
    docs = spark.createDataFrame([(i, f"text of number {i}") for i in range(50)], "doc_id long, text string")
    write_token_files(docs.coalesce(1), str(tmp_path / "f"), PATH, 2)
    files = sorted(Path(tmp_path / "f").glob("part-*"))
    whole = b""
    for file in files:
        with zstandard.ZstdDecompressor().stream_reader(file.read_bytes(), read_across_frames=True) as stream:
            whole += stream.read()
    assert whole == b"".join(ids_of(library, f"text of number {i}") for i in range(50))
    some = read_token_files(spark, str(tmp_path / "f"), doc_ids=[7, 31, 99]).collect()
    assert {r.doc_id: bytes(r.ids) for r in some} == {i: ids_of(library, f"text of number {i}") for i in (7, 31)}

    content = bytearray(files[0].read_bytes())
    entries = seek_table(bytes(content))
    _, _, offset, size, _, _ = entries[1]
    content[offset + size - 6] ^= 1
    untouched = {entries[0][0]}
    assert list(token_files.frames_of(bytes(content), untouched))  # the other frames are not read
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.frames_of(bytes(content)))
    with pytest.raises((ValueError, struct.error)):
        seek_table(bytes(content[:-1]))


def test_like_the_library_on_all_texts(spark, library):
    from tapewatch.llm.queries import op9_token_files

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = sorted(op9_token_files(spark, "/root/testdata/sf0.001").collect(), key=lambda r: r.doc_id)
    start = 0
    for row in rows:
        ids = ids_of(library, docs[row.doc_id])
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids))
        start += row.n_tokens
    assert len(rows) == len(docs)


def test_memory_of_words_is_bounded(library, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 5)
    monkeypatch.setattr(token_files, "CACHE_PARTS", 4)
    encoder = token_files.WordEncoder(PATH, 2)
    for text in ("one two three", "four five six one", "a b c d e f g h i j k", "漢 字 か な", "漢", "one", "", "one two"):
        assert encoder.encode(text) == ids_of(library, text)
        # over the limit by what one text adds at most
        assert len(encoder.words) <= 5 + 11 and len(encoder.parts) <= 4 + 11


WORDS = st.text("aZéÉßÿª'strevmld09½.,!<|endoftext>漢́_$\x1c\x00\x85\xa0 \t\n", max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(WORDS, st.sampled_from(["it's", "DON'T", "<|endoftext|>", "a<|startoftext|>b", "Σς", "İ"])), max_size=8))
def test_words_one_by_one_are_like_the_library(library, words):
    encoder = token_files.word_encoder(PATH, 2)
    plain = "".join(c for c in " ".join(words) if c in "aZéÉßÿ'strevmld09., <|end>_$")
    for text in (" ".join(words), "".join(words), plain, plain.upper()):
        assert encoder.encode(text) == ids_of(library, text)


TEXTS = ["Hello, world's  end\n\tIT'S 1234 <|endoftext|>", "", "  two  blanks ", "漢字 é É", "a b" * 300]


def variants(tmp_path):
    """Tokenizers with other settings: another vocabulary, no lower-casing, a prefix space, an added word."""
    from tokenizers import AddedToken, normalizers, pre_tokenizers

    yield public_tokenizers.path("byte_bpe_50k.json")
    for name in ("cased", "spaced", "added", "cut"):
        changed = Tokenizer.from_file(PATH)
        if name == "cased":
            changed.normalizer = normalizers.NFC()
        elif name == "spaced":
            changed.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
        elif name == "added":
            changed.add_tokens([AddedToken("world", single_word=True, normalized=True)])
        else:
            changed.enable_truncation(3)
        changed.save(str(tmp_path / f"{name}.json"))
        yield str(tmp_path / f"{name}.json")


def test_other_tokenizers_get_whole_texts(library, tmp_path):
    assert token_files.WordEncoder(PATH, 2).by_parts
    for path in variants(tmp_path):
        encoder, other = token_files.WordEncoder(path, 2), Tokenizer.from_file(path)
        assert not encoder.by_parts
        for text in TEXTS:
            assert encoder.encode(text) == ids_of(other, text)


def test_lookups_open_only_files_that_can_hold_the_documents(spark, library, tmp_path):
    rows = [(i, f"number {i}") for i in range(200)] + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = str(tmp_path / "f")
    write_token_files(docs, folder, PATH, 2, file_bytes=100)
    token_files.file_ranges(spark, folder).write.parquet(str(tmp_path / "ranges"))
    ranges = spark.read.parquet(str(tmp_path / "ranges"))
    stored = ranges.collect()
    assert len(stored) > 10 and sum(row.n_documents for row in stored) == len(rows)
    wanted = [3, 150, 999]
    kept = {row.path for row in stored if any((row.first_id or 0) <= i <= (row.last_id or -1) for i in wanted)}
    for row in stored:  # a file that is opened although it cannot hold a wanted document would raise
        if row.path not in kept:
            Path(row.path.removeprefix("file:")).write_bytes(b"damaged")
    found = read_token_files(spark, folder, doc_ids=wanted, ranges=ranges).collect()
    assert {r.doc_id: bytes(r.ids) for r in found} == {i: ids_of(library, f"number {i}") for i in (3, 150)}
    assert 0 < len(kept) <= 4
    assert read_token_files(spark, folder, doc_ids=[999], ranges=ranges).collect() == []
    assert read_token_files(spark, folder, doc_ids=[], ranges=ranges).collect() == []
