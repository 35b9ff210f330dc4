"""Language identification by word-first backoff.

A word seen in training scores by its log frequency in each language. A word not seen backs off to
its longest known character n-grams: at each place the longest n-gram with a count is taken, down
to single characters, each step down costing a constant. A text's score of a language is the sum
over its words; the language with the highest sum wins. Frequencies are smoothed towards those of all
languages together, so that a word which a language never showed does not favour one with few words.

Training counts over a bounded sample of labelled documents (`TRAIN_DOCUMENTS` of up to
`TRAIN_BYTES` each, in up to `LANGUAGES` languages) and keeps every word and n-gram of it: the sample
is the bound. The tables are sparse: one shared value for all languages that never showed a word, and
one number for each that did. One function splits texts into words, in training and in prediction;
a worker scores the distinct words of some megabytes of text once and adds up per document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.llm.support import cut, kept_in_worker, pieces_of, release_tables, slices, trimmed

UNDETERMINED = "und"
#: The training sample: documents, as expected of thresholds on a hash (all if there are fewer); the
#: bytes of one of them at most; the most frequent languages that are learnt.
TRAIN_DOCUMENTS, TRAIN_BYTES, LANGUAGES = 8_000, 1 << 18, 1_000
GRAM_SIZES = (4, 3, 2, 1)
#: Log score that each step to a shorter n-gram costs.
BACKOFF = math.log(0.4)
#: Part of a frequency that is taken from all languages together: all that a language has of what it never showed.
SMOOTHING = 0.1
#: Numbers that a worker remembers for words that it had to back off for.
CACHE_NUMBERS = 200_000
#: Bytes of text that a worker splits at a time, for four languages; fewer for more.
CHUNK_BYTES = 2 << 20

_NO_LETTERS = r"[^\pL]+"


def words_of(texts: pa.Array) -> pa.ListArray:
    """The lower-case words of each text: runs of letters. Empty words stand at the ends of some."""
    return pc.split_pattern_regex(pc.utf8_lower(texts), _NO_LETTERS)


@dataclass(frozen=True, eq=False)
class Table:
    """Log frequencies of `keys`: `shared` for all languages, and `more` for those in `lang`.

    The numbers of key i are at `starts[i]` to before `starts[i + 1]`.
    """

    keys: list[str] = field(default_factory=list)
    shared: np.ndarray = field(default_factory=lambda: np.zeros(0))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int64))
    lang: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))
    more: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def dense(self, rows: np.ndarray, languages: int) -> np.ndarray:
        """One line per row number, one column per language."""
        out = np.repeat(self.shared[rows], languages).reshape(-1, languages)
        first, count = self.starts[rows], self.starts[rows + 1] - self.starts[rows]
        line = np.repeat(np.arange(len(rows)), count)
        within = np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(first, count) + within
        out[line, self.lang[at]] += self.more[at]
        return out


@dataclass(frozen=True, eq=False)
class Model:
    languages: tuple[str, ...]
    words: Table
    grams: Table


def _table(counts: pa.Table, languages: list[str]) -> Table:
    """From rows (key, lang, n), one for each key and language.

    Each frequency is a mixture with the frequency over all languages, in one proportion for all.
    What a language never showed has the same value in every such language, however few words it has.
    """
    if not counts.num_rows:
        return Table()
    counts = counts.sort_by([("key", "ascending"), ("lang", "ascending")])
    keys = counts.column("key").combine_chunks().dictionary_encode()
    n = counts.column("n").to_numpy().astype(float)
    number = {lang: i for i, lang in enumerate(languages)}
    lang = np.array([number[name] for name in counts.column("lang").to_pylist()], dtype=np.int32)
    place = keys.indices.to_numpy()  # in order of the sorted keys
    own = np.maximum(1.0, np.bincount(lang, n, minlength=len(languages)))
    shared = SMOOTHING * np.bincount(place, n) / max(1.0, n.sum())
    value = np.log((1 - SMOOTHING) * n / own[lang] + shared[place])
    starts = np.concatenate([[0], np.cumsum(np.bincount(place))])
    return Table(keys.dictionary.to_pylist(), np.log(shared), starts, lang, value - np.log(shared)[place])


def _word_counts(sample: DataFrame) -> DataFrame:
    """(key, lang, n) of a sample (lang, text)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in batches:
            for part in slices(batch, 1, CHUNK_BYTES):
                words = words_of(part.column(1))
                parent = pc.list_parent_indices(words)
                table = pa.table({"lang": pc.take(part.column(0), parent), "key": pc.list_flatten(words)})
                table = table.filter(pc.not_equal(table.column("key"), ""))
                found = table.group_by(["key", "lang"]).aggregate([([], "count_all")])
                yield from found.rename_columns(["key", "lang", "n"]).cast(
                    pa.schema([("key", pa.string()), ("lang", pa.string()), ("n", pa.int64())])
                ).combine_chunks().to_batches()

    rows = sample.select("lang", "text").mapInArrow(counted, "key string, lang string, n long")
    return rows.groupBy("key", "lang").agg(F.sum("n").alias("n"))


def _gram_counts(words: DataFrame) -> DataFrame:
    """(key, lang, n) of the n-grams of words between `<` and `>`."""
    padded = F.concat(F.lit("<"), F.col("key"), F.lit(">"))

    def of_size(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length("word") - size + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.substring(F.col("word"), i, F.lit(size)))

    grams = F.flatten(F.array(*map(of_size, GRAM_SIZES)))
    rows = words.select("lang", "n", padded.alias("word")).select("lang", "n", F.explode(grams).alias("key"))
    return rows.groupBy("key", "lang").agg(F.sum("n").alias("n"))


def train(
    labelled: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    documents: int = TRAIN_DOCUMENTS,
    document_bytes: int = TRAIN_BYTES,
    most_languages: int = LANGUAGES,
) -> Model:
    """A model of the languages in `labelled`; rows without a text or a language are left out.

    The sample is spread evenly over languages: of each, the documents whose hash of id and text is
    below a threshold that `documents / languages` of them are expected to pass; of those with over
    `document_bytes` none. Of more than `most_languages` the most frequent are learnt, of equally
    frequent ones those first in order. No labelled row at all gives a model that finds every text
    undetermined.
    """
    rows = labelled.select(
        F.col(id_column).alias("id"),
        F.col(lang_column).cast("string").alias("lang"),
        F.col(text_column).alias("text"),
    ).filter(F.col("lang").isNotNull() & (F.octet_length("text") <= document_bytes))
    frequent = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages)
    counts = {row["lang"]: row["count"] for row in frequent.collect()}
    languages = sorted(counts)
    if not languages:
        return Model((), Table(), Table())
    # Documents below a threshold of a uniform hash, one per language: no text is moved to choose them.
    share = documents / len(languages)
    limits = F.create_map(
        *[x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, share / counts[lang]) * 2.0**53))]
    )
    place = F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string"), "text"), 11).cast("double")
    words = cut(_word_counts(rows.filter(place < limits[F.col("lang")])))
    return Model(
        tuple(languages),
        _table(words.toArrow(), languages),
        _table(_gram_counts(words).toArrow(), languages),
    )


class Scorer:
    """Scores words with a model; remembers a bounded number of words that it had to back off for."""

    def __init__(self, model: Model):
        self.model = model
        self.size = len(model.languages)
        self.place = {word: i for i, word in enumerate(model.words.keys)}
        self.gram = {gram: i for i, gram in enumerate(model.grams.keys)}
        self.other: dict[str, np.ndarray] = {}
        self.chunk = max(1 << 12, CHUNK_BYTES * 4 // max(4, self.size))

    def backoff(self, word: str) -> np.ndarray:
        """Mean over the places of a word of the longest known n-gram there, per language."""
        found = self.other.get(word)
        if found is not None:
            return found
        padded, rows, cost = f"<{word}>", [], 0.0
        for start in range(len(padded)):
            for steps, size in enumerate(GRAM_SIZES):
                row = self.gram.get(padded[start : start + size]) if start + size <= len(padded) else None
                if row is not None:
                    rows.append(row)
                    cost += steps * BACKOFF
                    break
        found = np.zeros(self.size)
        if rows:
            found = (self.model.grams.dense(np.array(rows), self.size).sum(axis=0) + cost) / len(rows)
        trimmed(self.other, max(1, CACHE_NUMBERS // max(1, self.size)))
        self.other[word] = found
        return found

    def _scores(self, words: list[str]) -> np.ndarray:
        """One line per word; the empty word has zeros."""
        out = np.zeros((len(words), self.size))
        rows = [self.place.get(word, -1) for word in words]
        known = np.flatnonzero(np.array(rows) >= 0)
        if len(known):
            out[known] = self.model.words.dense(np.array(rows)[known], self.size)
        for i, row in enumerate(rows):
            if row < 0 and words[i]:
                out[i] = self.backoff(words[i])
        return out

    def _sums(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(sum of the words' scores, number of words) of each of some not too long texts."""
        lists = words_of(texts)
        tokens = pc.list_flatten(lists).dictionary_encode()
        names, at = tokens.dictionary.to_pylist(), tokens.indices.to_numpy()
        first = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        full = np.array([bool(name) for name in names])
        return np.add.reduceat(self._scores(names)[at], first, axis=0), np.add.reduceat(full[at].astype(int), first)

    def predict_all(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language of each text and the model's probability of it, from the mean score of a word."""
        sums, total = np.zeros((len(texts), self.size)), np.zeros(len(texts), dtype=int)
        if self.size:
            filled, done = pc.fill_null(texts, ""), 0
            for part in slices(pa.RecordBatch.from_arrays([filled], ["text"]), 0, self.chunk):
                column, rows = part.column(0), part.num_rows
                if rows == 1 and pc.binary_length(column)[0].as_py() > self.chunk:
                    for piece in pieces_of(column[0].as_py().encode(), self.chunk):
                        found = self._sums(pa.array([piece.decode()]))
                        sums[done] += found[0][0]
                        total[done] += found[1][0]
                else:
                    sums[done : done + rows], total[done : done + rows] = self._sums(column)
                done += rows
        some = total > 0
        langs = [UNDETERMINED] * len(texts)
        scores = np.zeros(len(texts))
        if some.any():
            best = np.argmax(sums[some], axis=1)
            apart = sums[some] - sums[some].max(axis=1, keepdims=True)
            sharp = np.exp(apart / np.sqrt(total[some])[:, None])
            scores[some] = np.minimum(1.0, 1.0 / sharp.sum(axis=1))
            for i, k in zip(np.flatnonzero(some), best):
                langs[i] = self.model.languages[k]
        return langs, scores

    def predict(self, text: str | None) -> tuple[str, float]:
        langs, scores = self.predict_all(pa.array([text], pa.string()))
        return langs[0], float(scores[0])


def scorer_of(model: Model) -> Scorer:
    """One per worker and model: tasks of a worker share its memory of words, and leave none behind."""
    return kept_in_worker(model, lambda: Scorer(model))


def predicted(text: Column, model: Model) -> Column:
    """Struct (lang, score) of each text. Null text or one without a letter: `und`, 0."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = scorer_of(shared.value)
        for texts in batches:
            langs, scores = scorer.predict_all(texts)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], ["lang", "score"])

    return column(text)
