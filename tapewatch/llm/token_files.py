"""Token files: independent zstandard frames with a trailing seek table.

A file holds the token numbers of documents in ascending order of their ids:

    record, gap, record, gap, ..., seek table, gap

* A record is one or more zstandard frames, each of at most `FRAME_TOKENS` token numbers of one
  document as little-endian unsigned 32-bit integers. Frames are independent and carry zstandard's own
  checksum of their content.
* A gap is an empty skippable frame: `50 2A 4D 18 00 00 00 00`.
* The seek table is a skippable frame (`5E 2A 4D 18`, size) whose content is one entry per frame, then
  the number of entries and a magic number. An entry is: document id, flags (1: has an id, 2: first
  frame of its document), offset in the file, compressed size, token count, CRC-32 of the content.

So any zstandard tool reads a file as one stream, and a reader that wants some documents looks them
up in the table and decompresses their frames only.

Files are written by Spark's text writer, whose line separator is the gap: frames reach whatever
store Spark can write to, under Spark's commit protocol, and a lost executor's tasks are done again.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewatch.llm.support import kept_in_worker, pieces_of, trimmed

#: Token numbers in a frame at most: what a reader holds at a time.
FRAME_TOKENS = 1 << 20
#: Compressed bytes that are put into one record, about.
RECORD_BYTES = 1 << 20
#: Bytes of text that go to one file, about.
FILE_BYTES = 32 << 20
LEVEL = 3

GAP = "P*M\x18\0\0\0\0"
GAP_BYTES = GAP.encode()
TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A5E, 0x5EEC7AB1
ENTRY = struct.Struct("<qBQIII")
FOOTER = struct.Struct("<II")
HAS_ID, FIRST = 1, 2

#: Parts and words that a worker remembers the tokens of.
CACHE_PARTS, CACHE_WORDS = 500_000, 50_000

#: Texts of ASCII and Latin-1 letters, which the tokenizer's own splitting pattern takes apart like this
#: once they are lower-case.
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
_PARTS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+")


# The settings of the tokenizers whose texts may be taken apart like this.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def _settings(component) -> dict | None:
    return json.loads(component.__getstate__()) if component is not None else None


def splits_by_parts(tokenizer) -> bool:
    """Whether a text's tokens are those of its parts: known settings, nothing random, nothing cut or padded."""
    added = tokenizer.get_added_tokens_decoder().values()
    plain_added = not any(
        token.normalized or token.single_word or token.lstrip or token.rstrip or token.content.split() != [token.content]
        for token in added
    )
    return (
        plain_added
        and _settings(tokenizer.normalizer) == _NORMALIZER
        and _settings(tokenizer.pre_tokenizer) == _PRE_TOKENIZER
        and not getattr(tokenizer.model, "dropout", None)
        and tokenizer.truncation is None
        and tokenizer.padding is None
    )


class Parts(dict):
    """Tokens of parts of words, by the library's model, remembered."""

    def __init__(self, model):
        from tokenizers.pre_tokenizers import ByteLevel

        self.model = model
        self.bytes = ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, part: str) -> bytes:
        symbols = part if part.isascii() else self.bytes.pre_tokenize_str(part)[0][0]
        found = [token.id for token in self.model.tokenize(symbols)]
        ids = self[part] = struct.pack(f"<{len(found)}I", *found)
        return ids


class WordEncoder:
    """Token numbers of texts, by the tokenizers library, remembered by part or word.

    For tokenizers that lower-case, drop white space and split words into runs of letters, single
    digits, contractions and runs of the rest (`splits_by_parts`): a text's tokens are those of its
    parts, one after the other. Parts of plain texts go to the library's model; the words of other
    texts, between ASCII white space, go to the whole library. Every other tokenizer gets whole texts.
    """

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_parts = splits_by_parts(self.tokenizer)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.end = struct.pack("<I", end)
        self.parts = Parts(self.tokenizer.model)
        self.words: dict[str, bytes] = {}

    def _by_word(self, words: list[str]) -> bytes:
        trimmed(self.words, CACHE_WORDS)
        new = list({word for word in words if word not in self.words})
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.words.update((word, struct.pack(f"<{len(one)}I", *one.ids)) for word, one in zip(new, found))
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str | None) -> bytes:
        """Token numbers as little-endian 32-bit integers, then the end number."""
        if not self.by_parts:
            ids = self.tokenizer.encode(text or "", add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids) + self.end
        out = []
        for data in pieces_of((text or "").encode()):
            piece = data.decode()
            if _PLAIN.fullmatch(piece) and not any(token in piece for token in self.special):
                trimmed(self.parts, CACHE_PARTS)
                out.append(b"".join(map(self.parts.__getitem__, _PARTS.findall(piece.lower()))))
            else:
                out.append(self._by_word([word.decode() for word in data.split()]))
        return b"".join(out) + self.end


def word_encoder(path: str, end: int) -> WordEncoder:
    """One per worker and file, so that its memory of words outlives a task."""
    return kept_in_worker(("word_encoder", path, end), lambda: WordEncoder(path, end))


class FileWriter:
    """The records of one file, and its seek table."""

    def __init__(self):
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.entries: list[bytes] = []
        self.pending: list[bytes] = []
        self.size = self.at = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[bytes]:
        """Takes a document; gives records that are full."""
        flags = FIRST | (HAS_ID if doc_id is not None else 0)
        for start in range(0, max(len(ids), 1), 4 * FRAME_TOKENS):
            content = ids[start : start + 4 * FRAME_TOKENS]
            frame = self.compressor.compress(content)
            self.entries.append(
                ENTRY.pack(doc_id or 0, flags, self.at, len(frame), len(content) // 4, zlib.crc32(content))
            )
            flags &= ~FIRST
            self.pending.append(frame)
            self.at += len(frame)
            self.size += len(frame)
            if self.size >= RECORD_BYTES:
                yield self._record()

    def _record(self) -> bytes:
        record = b"".join(self.pending)
        self.pending, self.size = [], 0
        self.at += len(GAP_BYTES)
        return record

    def finish(self) -> Iterator[bytes]:
        """The last record and the seek table."""
        if self.pending:
            yield self._record()
        table = b"".join(self.entries) + FOOTER.pack(len(self.entries), FOOTER_MAGIC)
        yield struct.pack("<II", TABLE_MAGIC, len(table)) + table


def seek_table(content: bytes) -> list[tuple]:
    """Entries (document id or None, first, offset, size, tokens, checksum) of a file's content."""
    end = len(content) - len(GAP_BYTES)
    count, magic = FOOTER.unpack_from(content, end - FOOTER.size)
    if content[end:] != GAP_BYTES or magic != FOOTER_MAGIC:
        raise ValueError("not a token file, or cut short")
    start = end - FOOTER.size - count * ENTRY.size
    return [
        (doc_id if flags & HAS_ID else None, bool(flags & FIRST), *rest)
        for doc_id, flags, *rest in ENTRY.iter_unpack(content[start : end - FOOTER.size])
    ]


def frames_of(content: bytes, wanted: set[int] | None = None) -> Iterator[tuple[int | None, bool, bytes]]:
    """(document id, first frame, token numbers) of each frame, of `wanted` documents only if given."""
    reader = zstandard.ZstdDecompressor()
    for doc_id, first, offset, size, tokens, checksum in seek_table(content):
        if wanted is not None and doc_id not in wanted:
            continue
        ids = reader.decompress(content[offset : offset + size], max_output_size=4 * tokens)
        if len(ids) != 4 * tokens or zlib.crc32(ids) != checksum:
            raise ValueError(f"a frame of document {doc_id} is damaged")
        yield doc_id, first, ids


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Encodes each text and writes token files to `folder`, in ascending order of ids over all files.

    Null and empty texts have the end number only. Rows without an id come first and keep none.
    Repeated ids stay separate documents, ordered by a hash of their text, then by the text; repeated
    rows stay too. An empty table gives a folder without token files. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spark = docs.sparkSession
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = word_encoder(tokenizer, end), None
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                writer = writer or FileWriter()
                for record in writer.add(doc_id, encoder.encode(text.as_py())):
                    yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], ["record"])
        for record in writer.finish() if writer else ():
            yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], ["record"])

    # texts are sorted before they are encoded: the range sort samples its input and would encode twice
    tie = F.xxhash64("text")
    (
        rows.withColumn("tie", tie)
        .repartitionByRange(files, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
        .mapInArrow(records, "record binary")
        .select(F.col("record").cast("string").alias("value"))  # the same bytes
        .write.mode("overwrite")
        .option("lineSep", GAP)
        .option("compression", "none")
        .option("maxRecordsPerFile", 0)
        .text(folder)
    )


def _token_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(paths)
    return files.filter(F.col("length") > 0)


def file_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """One row per token file: path, n_documents, first_id and last_id (null if no document has one).

    Reads every file once, but only its seek table is looked at. Store the rows (as Parquet, say)
    and give them to `read_token_files`, so that a lookup opens the files that can hold its documents.
    """

    def ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for path, content in zip(files.column(0).to_pylist(), files.column(1)):
                entries = seek_table(content.as_py())
                ids = [doc_id for doc_id, *_ in entries if doc_id is not None]
                row = [path, sum(first for _, first, *_ in entries), min(ids, default=None), max(ids, default=None)]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
                names = ["path", "n_documents", "first_id", "last_id"]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    found = _token_files(spark, [folder]).select("path", "content")
    return found.mapInArrow(ranges, "path string, n_documents long, first_id long, last_id long")


def _paths_with(ranges: DataFrame, wanted: set[int]) -> list[str]:
    """Paths of the files whose range holds a wanted id: at most as many as ids, or as files share a range."""
    ids = F.array(*[F.lit(one).cast("long") for one in sorted(wanted)])
    holds = F.exists(ids, lambda one: one.between(F.col("first_id"), F.col("last_id")))
    return [row.path for row in ranges.filter(holds).select("path").collect()]


def read_token_files(
    spark: SparkSession,
    folder: str,
    doc_ids: Iterable[int] | None = None,
    with_ids: bool = True,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """Documents in token files: file, ordinal (in the file), doc_id, n_tokens, ids_crc32 and ids.

    `ids` are little-endian 32-bit integers, the end number included, or null without `with_ids`.
    With `doc_ids` only the frames of those documents are decompressed, and with `ranges` (of
    `file_ranges`) as well only the files that can hold them are opened. A damaged file raises.
    """
    wanted = None if doc_ids is None else set(doc_ids)
    names = ["file", "ordinal", "doc_id", "n_tokens", "ids_crc32", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(found: list[list]) -> pa.RecordBatch:
            columns = [pa.array(list(values), kind) for values, kind in zip(zip(*found), kinds)]
            return pa.RecordBatch.from_arrays(columns, names)

        for files in batches:
            for number, content in zip(files.column(0).to_pylist(), files.column(1)):
                found: list[list] = []
                size = ordinal = 0
                for doc_id, first, ids in frames_of(content.as_py(), wanted):
                    if first:
                        if size >= 4 * FRAME_TOKENS:
                            yield batch(found)
                            found, size = [], 0
                        found.append([number, ordinal, doc_id, 0, 0, b"" if with_ids else None])
                        ordinal += 1
                    row = found[-1]
                    row[3] += len(ids) // 4
                    row[4] = zlib.crc32(ids, row[4])
                    if with_ids:
                        row[5] += ids
                    size += len(ids)
                if found:
                    yield batch(found)

    layout = "file long, ordinal long, doc_id long, n_tokens long, ids_crc32 long, ids binary"
    paths = [folder]
    if wanted is not None and ranges is not None:
        paths = _paths_with(ranges, wanted)
        if not paths:
            return spark.createDataFrame([], layout)
    number = F.regexp_extract(F.col("path"), r"part-(\d+)", 1).cast("long")
    return _token_files(spark, paths).select(number.alias("file"), "content").mapInArrow(rows, layout)


def with_starts(documents: DataFrame) -> DataFrame:
    """`documents` of `read_token_files` with `start`: the token numbers of all documents before each.

    Sums run inside a file; only one total per file is summed over all files.
    """
    inside = Window.partitionBy("file").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    totals = documents.groupBy(F.col("file").alias("of")).agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("of", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"))
    return (
        documents.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(offsets, F.col("file") == F.col("of"))
        .withColumn("start", F.col("offset") + F.col("inside"))
        .drop("of", "offset", "inside")
    )
