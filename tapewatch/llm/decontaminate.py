"""Benchmark decontamination: word n-gram seeds, rarest first, then Smith-Waterman alignment.

No match is left out. An alignment of at least the score asked for must share a number of word pairs
with the item, within a band of places that its gaps can span (`_demand`). So of an item's pairs,
ordered by the number of training documents that have them, all but the most frequent ones are
seeds: as many that no such alignment can do without all of them. A document with a seed is
looked through for all pairs of the item, and where enough of them stand at consistent places the
words around are aligned with the item; the local alignment score, as a share of the best possible
one, tells exact, edited and paraphrased copies from chance. An item that leaked into a third of all
documents, whole or edited, is found by the same rule.

The test set is handled in blocks of at most `BLOCK_WORDS` words, one after the other: that is the
proven bound of what is sent to the workers; of `BLOCKS_AT_ONCE` blocks the functions run in one
stage, then the rows are written out. Documents are read twice per block and never shuffled: once to count documents per n-gram, once to seed and align. N-grams are exact (numbers of
words in the block's vocabulary), not hashes.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.llm.support import cut, pieces_of, release_tables, unused

#: Seeds per item at least, the rarest; more wherever a match could do without these.
SEEDS_PER_ITEM = 16
#: Share of an item's best possible alignment score from which a document counts as contaminated.
MIN_SCORE = 0.6
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of test items in a block: what one pass over the documents sends to every worker.
BLOCK_WORDS = 400_000
#: Blocks whose functions run in one stage; after so many the rows are written to the shared folder.
BLOCKS_AT_ONCE = 4

MATCHES = "array<struct<item: bigint, score: double, first_word: bigint, last_word: bigint>>"
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """Lower-case words of a text, in lists of bounded length."""
    for piece in pieces_of((text or "").lower().encode()):
        yield _WORD.findall(piece)


def grams_of(ids: np.ndarray, vocabulary: int, size: int) -> np.ndarray:
    """The number of each `size`-gram of word numbers; -1 where a word is unknown.

    Exact: the vocabulary of a block is small enough for three numbers in 63 bits.
    """
    if len(ids) < size:
        return np.empty(0, dtype=np.int64)
    grams = np.zeros(len(ids) - size + 1, dtype=np.int64)
    known = np.ones(len(grams), dtype=bool)
    for k in range(size):
        part = ids[k : len(ids) - size + 1 + k]
        grams = grams * vocabulary + part
        known &= part >= 0
    return np.where(known, grams, -1)


def alignment(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman: (share of the best possible score, first, last word aligned in `passage`).

    Row by row over the item; a run of gaps along a row is a running maximum. Words are numbers, -1
    matches nothing. Of equal scores the leftmost end is taken.
    """
    length = len(passage)
    if not len(item) or not length:
        return 0.0, 0, -1
    steps = np.arange(length + 1) * GAP
    score, start = np.zeros(length + 1, dtype=np.int64), np.arange(length + 1)
    best, first, last = 0, 0, -1
    for word in item:
        fit = np.where((passage == word) & (word >= 0), MATCH, MISMATCH)
        down, diagonal = score + GAP, np.concatenate(([0], score[:-1] + fit))
        new = np.maximum(np.maximum(down, diagonal), 0)
        begin = np.where(new == 0, np.arange(length + 1), np.where(diagonal >= down, np.concatenate(([0], start[:-1])), start))
        # a gap in the item: the best of all places to the left, less the gaps from there
        lifted = new - steps
        running = np.maximum.accumulate(lifted)
        origin = np.maximum.accumulate(np.where(lifted == running, np.arange(length + 1), 0))
        score = running + steps
        start = begin[origin]
        end = int(np.argmax(score))
        if score[end] > best:
            best, first, last = int(score[end]), int(start[end]), end - 1
    return best / (MATCH * len(item)), first, last


@dataclass(frozen=True)
class Demand:
    """What any alignment of a score has: `shared` places of the item's n-grams of `size` words, all on
    diagonals (word of the text less word of the item) at most `band` apart."""

    size: int
    shared: int
    band: int


def _demand(length: int, min_score: float) -> Demand:
    """For an item of `length` words.

    Of m words that match, e errors between them: the score is 2 m - e, and m <= length, so there are at
    most 2 length (1 - min_score) errors, gaps among them. Two matches in a row without an error
    between them are a pair; there are at least m - 1 - e of these, hence (2 min_score - 1) length - 1.
    Where that promises no pair, single words are counted: m is at least min_score length.
    """
    band = max(0, math.floor((MATCH * length) * (1 - min_score) + 1e-9))
    pairs = math.ceil((2 * min_score - 1) * length - 1 - 1e-9)
    if pairs > 0:
        return Demand(2, pairs, band)
    return Demand(1, max(1, math.ceil(min_score * length - 1e-9)), band)


@dataclass(frozen=True)
class Block:
    """Test items as word numbers; for each n-gram the places (item, word) it has, and which are seeds."""

    vocabulary: dict[bytes, int]
    numbers: list[int]
    items: list[np.ndarray]
    demands: list[Demand]
    places: dict[int, list[tuple[int, int]]]
    seeds: dict[int, list[tuple[int, int]]]

    def grams(self, ids: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the n-grams of one or two words; no two n-grams share one. -1 for unknown words."""
        if size == 1:
            return ids
        found = grams_of(ids, len(self.vocabulary), size)
        return np.where(found >= 0, found + len(self.vocabulary), -1)

    def found(self, ids: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, n-grams) of those n-grams of a text that the sorted `table` has."""
        places, grams = [], []
        for size in {demand.size for demand in self.demands}:
            given = self.grams(ids, size)
            at = _wanted(given, table)
            places.append(at)
            grams.append(given[at])
        if not places:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate(places), np.concatenate(grams)


def _ids(text: str | None, vocabulary: dict[bytes, int]) -> np.ndarray:
    get = vocabulary.get
    parts = [np.fromiter((get(w, -1) for w in found), np.int64, len(found)) for found in words_of(text)]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


def _wanted(grams: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Positions of those `grams` that the sorted `table` has."""
    if not len(table) or not len(grams):
        return np.empty(0, dtype=np.int64)
    at = np.searchsorted(table, grams)
    at[at == len(table)] = 0
    return np.flatnonzero((table[at] == grams) & (grams >= 0))


def _stretches(hits: list[tuple[int, int]], demand: Demand, length: int) -> Iterator[tuple[int, int]]:
    """Stretches (first word, after the last) of the text that hold every alignment meeting `demand`.

    `hits` are (diagonal, word of the item). Stretches that overlap come as one.
    """
    if len({word for _, word in hits}) < demand.shared:
        return
    hits.sort()
    inside: dict[int, int] = defaultdict(int)
    left, low, high = 0, None, None
    for diagonal, word in hits:
        inside[word] += 1
        while diagonal - hits[left][0] > demand.band:
            gone = hits[left][1]
            inside[gone] -= 1
            if not inside[gone]:
                del inside[gone]
            left += 1
        if len(inside) >= demand.shared:
            begin, end = hits[left][0] - demand.band, diagonal + demand.band + length
            if high is not None and begin > high:
                yield low, high
                low = None
            low, high = begin if low is None else low, end
    if high is not None:
        yield low, high


def _aligned(ids: np.ndarray, block: Block, tables: tuple[np.ndarray, np.ndarray], min_score: float) -> list[tuple]:
    """(item number, score, first, last word) of each item that the document contains.

    `tables` are the sorted seeds and the sorted n-grams of the block.
    """
    seeds, everything = tables
    _, grams = block.found(ids, seeds)
    wanted = {item for gram in np.unique(grams).tolist() for item, _ in block.seeds[gram]}
    if not wanted:
        return []
    hits = defaultdict(list)
    places, grams = block.found(ids, everything)
    for at, gram in zip(places.tolist(), grams.tolist()):
        for item, word in block.places[gram]:
            if item in wanted:
                hits[item].append((at - word, word))
    found = []
    for item, own in hits.items():
        words, best = block.items[item], (0.0, 0, -1)
        for low, high in _stretches(own, block.demands[item], len(words)):
            low = max(0, low)
            share, first, last = alignment(words, ids[low:high])
            if share > best[0]:
                best = (share, first + low, last + low)
        if best[0] >= min_score:
            found.append((block.numbers[item], *best))
    return sorted(found)


def _blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[int, bytes]]]:
    """The distinct items (number, words) in lists of about `block_words` words."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // (block_words * 4)))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(parts)))
    for part in range(parts):
        yield [(row["item"], row["text"]) for row in dealt.filter(F.col("block") == part).collect()]


def _block(rows: list[tuple[int, str]], min_score: float = MIN_SCORE) -> Block:
    vocabulary: dict[bytes, int] = {}
    items = []
    for _, text in rows:
        words = [word for found in words_of(text) for word in found]
        items.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], dtype=np.int64))
    if len(vocabulary) >= 2**21:
        raise ValueError("a block's vocabulary must stay below 2^21 words: lower block_words")
    demands = [_demand(len(words), min_score) for words in items]
    block = Block(vocabulary, [number for number, _ in rows], items, demands, defaultdict(list), {})
    for item, (words, demand) in enumerate(zip(items, demands)):
        for at, gram in enumerate(block.grams(words, demand.size).tolist() if len(words) else ()):
            block.places[gram].append((item, at))
    return block


def _with_seeds(docs: DataFrame, text_column: str, block: Block, seeds: int, whole: bool = False) -> Block:
    """`block` with the rarest n-grams of each item as seeds, by the number of documents that have them.

    `whole`: as many more that a text with the shared places that are demanded has a seed for certain.
    """
    spark = docs.sparkSession
    if not block.places:
        return block
    table = np.array(sorted(block.places), dtype=np.int64)
    shared = spark.sparkContext.broadcast((replace(block, numbers=[], items=[], places={}), table))

    @F.arrow_udf("array<bigint>")
    def present(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release_tables()
        block, wanted = shared.value
        for texts in batches:
            found = []
            for text in texts:
                found.append(np.unique(block.found(_ids(text.as_py(), block.vocabulary), wanted)[1]))
            yield pa.array(found, pa.list_(pa.int64()))

    counted = (
        docs.select(F.explode(present(F.col(text_column))).alias("gram"))
        .groupBy("gram")
        .agg(F.count("*").alias("documents"))
    )
    # one row per n-gram of the block at most, whatever the size of the corpus
    frequency = {row["gram"]: row["documents"] for row in counted.collect()}
    by_item: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    for gram, places in block.places.items():
        for item, at in places:
            by_item[item][gram].append(at)
    chosen: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for item, grams in by_item.items():
        # a text that has none of these places has fewer than are demanded
        least = sum(map(len, grams.values())) - block.demands[item].shared + 1 if whole else 0
        taken = passed = 0
        for gram in sorted(grams, key=lambda gram: (frequency.get(gram, 0), gram)):
            if taken >= seeds and passed >= least:
                break
            passed += len(grams[gram])
            if frequency.get(gram):  # n-grams that no document has cannot find one
                taken += 1
                chosen[gram] += [(item, at) for at in grams[gram]]
    return replace(block, seeds=dict(chosen))


def _matches(text: Column, block: Block, min_score: float) -> Column:
    shared = SparkSession.active().sparkContext.broadcast(block)

    @F.arrow_udf(MATCHES)
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release_tables()
        block = shared.value
        tables = (np.array(sorted(block.seeds), dtype=np.int64), np.array(sorted(block.places), dtype=np.int64))
        kind = pa.list_(
            pa.struct(
                [("item", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
            )
        )
        names = ("item", "score", "first_word", "last_word")
        for texts in batches:
            found = []
            for text in texts:
                ids = _ids(text.as_py(), block.vocabulary)
                rows = _aligned(ids, block, tables, min_score)
                found.append([dict(zip(names, row)) for row in rows])
            yield pa.array(found, kind)

    return column(text)


def with_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    matches: str = "matches",
    min_score: float = MIN_SCORE,
    seeds_per_item: int = SEEDS_PER_ITEM,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """`docs` with an array column: (item, score, first_word, last_word) of each test item found.

    Score 1 is a whole item word for word; words are counted from 0, runs of ASCII letters and digits
    and other characters, without regard to case. An item counts once per document, at its best
    place, the first of equal ones. Every item that scores `min_score` anywhere is found, whatever
    `seeds_per_item` (the least number of seeds): it changes the speed only. Null and empty texts have no matches, and items without words
    none either. Repeated items with the same
    number and text count once; rows of `docs` stay as they are, repeated ones too. An empty test set
    or table gives empty arrays or no rows. `matches` must be a new name.
    """
    if matches.lower() in {name.lower() for name in docs.columns}:
        raise ValueError(f"docs already has a column {matches}")
    items = (
        benchmark.select(F.col(item_column).cast("long").alias("item"), F.col(item_text_column).alias("text"))
        .filter(F.col("text").isNotNull())
        .distinct()
    )
    result = docs.withColumn(matches, F.lit(None).cast(MATCHES))
    name = F.col(matches)
    for number, rows in enumerate(_blocks(items, block_words)):
        if number and number % BLOCKS_AT_ONCE == 0:
            result = cut(result)
        block = _block(rows, min_score)
        if any(len(words) for words in block.items):
            block = _with_seeds(docs, text_column, block, seeds_per_item, whole=True)
            found = _matches(F.col(text_column), block, min_score)
            extra = unused(result, "found")
            result = result.withColumn(extra, found).withColumn(
                matches, F.concat(F.coalesce(name, F.array().cast(MATCHES)), F.col(extra))
            ).drop(extra)
    return result.withColumn(matches, F.coalesce(name, F.array().cast(MATCHES)))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """One row (doc_id, item_id, score, first_word, last_word) per document and test item in it."""
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(options.pop("text_column", "text")).alias("text"))
    marked = with_contamination(narrow, benchmark, **options)
    return marked.select("doc_id", F.explode("matches").alias("match")).select(
        "doc_id",
        F.col("match.item").alias("item_id"),
        F.col("match.score").alias("score"),
        F.col("match.first_word").alias("first_word"),
        F.col("match.last_word").alias("last_word"),
    )
