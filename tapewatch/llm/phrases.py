"""Phrases whose words stand together more often than apart, mined by Toivonen's sampling.

A sample of the documents proposes which words and pairs are frequent. A full pass then counts, over
all documents, every phrase whose shorter parts were all proposed: that is the proposed phrases
together with their negative border, the smallest phrases that were not proposed. If a border phrase
turns out frequent, the proposal has missed it and what it could grow into was not counted. Such
phrases are added, and a further full pass counts what they bring in, until a pass adds none. Then
every frequent phrase has been counted exactly, whatever the sample was: it sets the speed only.

Workers know the proposed phrases by two Bloom filters of at most `MAX_FILTER_BITS` bits, which are
all that is broadcast. A filter that says yes to more than was proposed makes a pass count more and
changes no result. A later pass skips what the filters of the earlier ones have let through.

Every worker counts a few megabytes at a time before its rows go to Spark, which adds them up before
and after the shuffle, so the most frequent word sends a row per task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewatch.llm.support import HOT_KEYS, cut

# What ends a piece; the letters that are lower-cased are A to Z.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
#: Stands between pieces; no word, as every separator ends one.
_GAP = b"."
_TO_GAP = bytes.maketrans(SEPARATORS, _GAP * len(SEPARATORS))

NO_LANGUAGE = "und"
MIN_COUNT = 10
#: A candidate goes if a longer one has this share of its occurrences at least, in hundredths.
COVERED = 50
PER_LANGUAGE = 2_000
#: One of so many documents is in the sample, and a phrase is proposed from so many occurrences on.
SAMPLE_OF, SAMPLE_COUNT = 8, 2
#: Bits of a filter for each proposed phrase; bits set by one; most bits of a filter.
FILTER_SHARE, FILTER_HASHES, MAX_FILTER_BITS = 16, 3, 1 << 27
#: Bytes of text that are counted at a time.
CHUNK_BYTES = 8 << 20

_COUNTS = "lang string, size int, phrase string, n long"


@dataclass(frozen=True, eq=False)
class Filters:
    """Bits of the proposed words and of the proposed pairs; None lets everything through."""

    words: np.ndarray
    pairs: np.ndarray

    def with_bits(self, more: Filters) -> Filters:
        return Filters(self.words | more.words, self.pairs | more.pairs)


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return [(hashes + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(FILTER_HASHES)]


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    there = np.ones(len(hashes), dtype=bool)
    for place in _places(hashes, len(bits) * 64):
        there &= (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0
    return there


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(word, seed) for word in words], dtype=np.uint64)


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right >> np.uint64(7)) ^ (right << np.uint64(57))
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def _chunks(texts: list[str | None], size: int) -> Iterator[tuple[bytes, int]]:
    """(bytes, words carried over): texts joined by gaps, in chunks of about `size`.

    A longer text is cut where a word ends; the two words before a cut begin the next chunk again.
    """
    held, total = [], 0
    for text in texts:
        data = (text or "").encode().lower().translate(_TO_GAP)
        start = carried = 0
        step = size
        while len(data) - start > step:
            end = start + step
            while end < len(data) and data[end] not in b" \t.":
                end += 1
            yield data[start:end], carried
            start, carried = _two_back(data, start, end)
            if end == len(data):
                start, carried = end, 0
            # the next chunk must get past its first two words and the blanks behind them
            step = max(size, 2 * (end - start))
        if carried:
            yield data[start:], carried
        else:
            held.append(data[start:])
            total += len(data) - start
        if total > size:
            yield b" . ".join(held), 0
            held, total = [], 0
    if held:
        yield b" . ".join(held), 0


def _two_back(data: bytes, start: int, end: int) -> tuple[int, int]:
    """Where the last two tokens of data[start:end] begin, and how many there are; a gap is a token."""
    at, found = end, 0
    while at > start and found < 2:
        while at > start and data[at - 1] in b" \t":
            at -= 1
        if at == start:
            break
        if data[at - 1 : at] == _GAP:
            at -= 1
        else:
            while at > start and data[at - 1] not in b" \t.":
                at -= 1
        found += 1
    return at, found


def _tokens(data: bytes) -> pa.DictionaryArray:
    """Words and gaps of a chunk in order."""
    spaced = data.replace(_GAP, b" . ").replace(b"\t", b" ")
    offsets = pa.py_buffer(np.array([0, len(spaced)], dtype=np.int64))
    whole = pa.LargeStringArray.from_buffers(1, offsets, pa.py_buffer(spaced))
    words = pc.split_pattern(whole, " ").values
    return words.filter(pc.not_equal(pc.binary_length(words), 0)).dictionary_encode()


def counted(
    lang: str, data: bytes, carried: int, old: Filters | None, new: Filters | None
) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(words, phrases, counts) of one chunk: phrases that `new` lets through and `old` did not.

    In the first pass (`old` is None) all single words are counted, and their number as the phrase
    of no words. `carried` tokens at the front were counted with the chunk before.
    """
    tokens = _tokens(data)
    at, words = tokens.indices.to_numpy().astype(np.int64), tokens.dictionary.cast(pa.string())
    names = words.to_pylist()
    if not len(at):
        return
    encoded = [name.encode() for name in names]
    is_word = np.array([name != _GAP for name in encoded])
    hashes = word_hashes(lang, encoded)
    if old is None:
        once = np.bincount(at[carried:], minlength=len(names))
        there = np.flatnonzero(is_word & (once > 0))
        yield 1, words.take(pa.array(there)), once[there]
        yield 0, pa.array([""]), np.array([once[is_word].sum()])
    good = is_word if new is None else is_word & _passes(new.words, hashes)
    pair = good[at[:-1]] & good[at[1:]]
    done = np.zeros(len(pair), dtype=bool)
    if old is not None:
        before = is_word & _passes(old.words, hashes)
        done = before[at[:-1]] & before[at[1:]]
    fresh = pair & ~done
    fresh[: max(0, carried - 1)] = False
    places = np.flatnonzero(fresh)
    if len(places):
        codes, n = np.unique(at[places] * len(names) + at[places + 1], return_counts=True)
        left, right = words.take(pa.array(codes // len(names))), words.take(pa.array(codes % len(names)))
        yield 2, pc.binary_join_element_wise(left, right, " "), n

    # threes: both pairs must be proposed
    places = np.flatnonzero(pair[:-1] & pair[1:])
    if not len(places):
        return
    first = pair_hashes(hashes[at[places]], hashes[at[places + 1]])
    second = pair_hashes(hashes[at[places + 1]], hashes[at[places + 2]])
    fresh = np.ones(len(places), dtype=bool)
    if new is not None:
        fresh = _passes(new.pairs, first) & _passes(new.pairs, second)
    if old is not None:
        known = done[places] & done[places + 1]
        known &= _passes(old.pairs, first) & _passes(old.pairs, second)
        fresh &= ~known
    fresh &= places + 2 >= carried
    places = places[fresh]
    if not len(places):
        return
    pairs, number = np.unique(at[places] * len(names) + at[places + 1], return_inverse=True)
    codes, n = np.unique(number * len(names) + at[places + 2], return_counts=True)
    begun, third = pairs[codes // len(names)], codes % len(names)
    three = [words.take(pa.array(part)) for part in (begun // len(names), begun % len(names), third)]
    yield 3, pc.binary_join_element_wise(*three, " "), n


def _pass(docs: DataFrame, old: Broadcast | None, new: Broadcast | None, chunk_bytes: int) -> DataFrame:
    """(lang, size, phrase, n) over all rows of `docs` (lang, text), see `counted`."""

    def column(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, now = old and old.value, new and new.value
        held: dict[str, list] = {}
        total = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                for data, carried in _chunks(texts, chunk_bytes):
                    for size, phrases, n in counted(lang, data, carried, before, now):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.repeat(pa.scalar(lang), len(n)),
                                pa.repeat(pa.scalar(size, pa.int32()), len(n)),
                                phrases,
                                pa.array(n, pa.int64()),
                            ],
                            ["lang", "size", "phrase", "n"],
                        )
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                plain = text.as_py()
                held.setdefault(lang, []).append(plain)
                total += len(plain or "")
                if total >= chunk_bytes:
                    yield from flushed()
                    total = 0
        yield from flushed()

    return docs.mapInArrow(column, _COUNTS).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def _hashes(lang: str, size: int, phrases: list[bytes]) -> np.ndarray:
    if size == 1:
        return word_hashes(lang, phrases)
    halves = [phrase.split(b" ") for phrase in phrases]
    return pair_hashes(*(word_hashes(lang, [half[i] for half in halves]) for i in (0, 1)))


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple[str, int, np.ndarray, list[bytes]]]:
    """(lang, size, places in the batch, phrases) of rows (lang, size, phrase, ...)."""
    groups: dict[tuple[str, int], list[int]] = {}
    for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
        groups.setdefault(key, []).append(i)
    phrases = batch.column(2).to_pylist()
    for (lang, size), places in groups.items():
        yield lang, size, np.array(places), [phrases[i].encode() for i in places]


def _filters(phrases: DataFrame, bits: int) -> Filters:
    """Filters of words and pairs (lang, size, phrase); one row per 64 bits comes to the driver."""

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, size, _, own in _grouped(batch):
                place = np.concatenate(_places(_hashes(lang, size, own), bits))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(size, pa.int32()), len(place)),
                        pa.array((place >> np.uint64(6)).astype(np.int32)),
                        pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64)),
                    ],
                    ["size", "at", "bits"],
                )

    found = (
        phrases.select("lang", "size", "phrase")
        .mapInArrow(set_bits, "size int, at int, bits long")
        .groupBy("size", "at")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    out = []
    sizes, places, values = (found.column(i).to_numpy() for i in range(3))
    for size in (1, 2):
        table = np.zeros(bits // 64, dtype=np.uint64)
        own = sizes == size
        table[places[own]] = values[own].view(np.uint64)
        out.append(table)
    return Filters(*out)


def _missed(counts: DataFrame, filters: Broadcast) -> DataFrame:
    """Words and pairs of `counts` that the filters do not let through."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = np.zeros(batch.num_rows, dtype=bool)
            for lang, size, places, own in _grouped(batch):
                bits = filters.value.words if size == 1 else filters.value.pairs
                mask[places] = ~_passes(bits, _hashes(lang, size, own))
            yield batch.filter(pa.array(mask))

    return counts.filter(F.col("size").isin(1, 2)).select("lang", "size", "phrase", "n").mapInArrow(kept, _COUNTS)


def phrase_counts(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    lang_column: str = "lang",
    text_column: str = "text",
    sample_of: int = SAMPLE_OF,
    sample_count: int = SAMPLE_COUNT,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(lang, size, phrase, n): every phrase of 1 to 3 words that occurs `min_count` times in its language.

    Size 0 has the number of all words of a language. The table is written to the shared folder.
    """
    spark = docs.sparkSession
    lang, text = F.col(lang_column).cast("string"), F.col(text_column)
    rows = docs.select(F.coalesce(lang, F.lit(NO_LANGUAGE)).alias("lang"), text.alias("text"))
    sample = rows.filter(F.pmod(F.xxhash64("lang", "text"), F.lit(sample_of)) == 0)
    proposed = cut(
        _pass(sample, None, None, chunk_bytes).filter(F.col("size").isin(1, 2) & (F.col("n") >= sample_count))
    )
    share = FILTER_SHARE * max(1, proposed.count())
    bits = min(MAX_FILTER_BITS, max(1 << 16, 1 << (share - 1).bit_length()))
    filters, old, found = _filters(proposed, bits), None, []
    while True:
        new = spark.sparkContext.broadcast(filters)
        counts = _pass(rows, old, new, chunk_bytes)
        found.append(cut(counts.filter((F.col("n") >= min_count) | (F.col("size") == 0))))
        missed = cut(_missed(found[-1], new))
        if missed.isEmpty():
            break
        filters, old = filters.with_bits(_filters(missed, bits)), new
    together = found[0]
    for part in found[1:]:
        together = together.unionByName(part)
    return together


def _words(phrase: Column, first: Column, count: Column) -> Column:
    """`count` words of a phrase from the word number `first` (from 1) on."""
    return F.array_join(F.slice(F.split(phrase, " "), first, count), " ")


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, score, l, r): the cut with the lowest score, the earliest of equal ones.

    Parts are looked up in `counts`. Parts that very many candidates share (at most `HOT_KEYS` of
    them) are looked up by a broadcast, the others by a join that has no large key then.
    """
    cuts = candidates.select(
        "lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "size"
    )
    phrase, k = F.col("phrase"), F.col("k")
    halves = F.array(_words(phrase, F.lit(1), k), _words(phrase, k + 1, F.col("size") - k))
    parts = cuts.select("lang", "phrase", "a", "k", F.posexplode(halves).alias("side", "part"))
    known = counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    often = parts.groupBy("lang", "part").count().orderBy(F.desc("count"), "lang", "part").limit(HOT_KEYS)
    hot = cut(often.join(known, ["lang", "part"]).select("lang", "part", F.col("times").alias("hot")))
    marked = parts.join(F.broadcast(hot), ["lang", "part"], "left")
    rest = marked.filter(F.col("hot").isNull()).drop("hot").join(known, ["lang", "part"])
    looked_up = marked.filter(F.col("hot").isNotNull()).withColumnRenamed("hot", "times").unionByName(rest)
    sides = looked_up.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("times"))).alias("l"),
        F.max(F.when(F.col("side") == 1, F.col("times"))).alias("r"),
    )
    whole = [F.col(name).cast("decimal(19,0)") for name in ("a", "l", "r")]
    # a <= l and a <= r, so a score is 1,000,000 at most; products have 38 digits
    ratio = F.call_function("div", (whole[0] * whole[0]) * F.lit(1_000_000).cast("decimal(7,0)"), whole[1] * whole[2])
    best = F.min(F.struct(ratio.alias("score"), "k", "l", "r")).alias("best")
    return sides.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.score", "best.l", "best.r")


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, per_language: int = PER_LANGUAGE, **options
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to 3 words of each language.

    Texts are lower-cased from A to Z and split into pieces at `SEPARATORS` and into words at blanks
    and tabs; phrases do not cross pieces, and every place counts. Of a phrase with a places, cut into
    parts with l and r places, the score is floor(1,000,000 a a / (l r)), at the cut where it is lowest.
    A phrase inside a longer candidate with half of its places at least is left out. Order: score, a,
    then the phrase's bytes. A null language is `und`, a null text has no word; repeated rows all
    count; an empty table gives no rows, as does a language without a candidate.
    """
    counts = phrase_counts(docs, min_count, **options)
    candidates = counts.filter(F.col("size") >= 2)
    pairs = F.array(*[_words(F.col("phrase"), F.lit(first), F.lit(2)) for first in (1, 2)])
    longer = candidates.filter(F.col("size") == 3).select("lang", F.explode(pairs).alias("phrase"), "n")
    covering = longer.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))
    kept = _scored(candidates, counts.filter(F.col("size").between(1, 2)))
    kept = kept.join(covering, ["lang", "phrase"], "left").filter(
        F.coalesce(F.col("longest") * 100 < F.col("a") * COVERED, F.lit(True))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= per_language)
    totals = counts.filter(F.col("size") == 0).select("lang", F.col("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
