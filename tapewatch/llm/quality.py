"""Quality classifier: ridge regression on random Fourier features, calibrated by isotonic regression.

A document is described by a few statistics of its text. Random Fourier features of the standardised
statistics, sqrt(2 / D) cos(W x + c) with normal W, have inner products near a Gaussian kernel, so a
linear fit on them is a kernel fit. Its normal equations are sums over rows: every partition adds up
its own D x D matrix, Spark adds up the partitions' rows, and the driver solves one system of fixed
size. The sums are kept per fold, so that fits without each fold come at no further pass; their
scores of the fold left out are binned, made monotone by pooling adjacent violators, and give the
probability that a score stands for.

All labelled rows are used. What reaches the driver is of fixed size: means, one matrix per fold, and
one row per bin of scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewatch.llm.support import cut, pieces_of, release_tables, slices

#: Features, folds, bins of scores per unit; ridge weight per row; seed of the random features.
FEATURES, FOLDS, BINS, RIDGE, SEED = 192, 4, 1024, 1e-4, 13
#: Width of the kernel in standard deviations, and where standardised statistics are cut off.
WIDTH, LARGEST = 4.0, 6.0
#: Scores of the fits lie around 0 to 1; beyond these they are binned with the last.
LEAST, MOST = -0.5, 1.5

_UPPER, _LOWER, _DIGIT, _BLANK, _LINE, _STOP, _MARK, _OTHER, _HIGH = range(9)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
for _chars, _kind in (
    (range(65, 91), _UPPER),
    (range(97, 123), _LOWER),
    (range(48, 58), _DIGIT),
    (b" \t", _BLANK),
    (b"\n\x0b\x0c\r", _LINE),
    (b".,;:'\"()?-", _STOP),
    (range(128, 256), _HIGH),
    (b"!#$%&*+/<=>@[\\]^_`{|}~", _MARK),
):
    _CLASS[list(_chars)] = _kind

STATISTICS = (
    "words", "word_length", "longest_word", "upper", "digits", "stops", "marks", "other", "high",
    "distinct_words", "top_word", "repeated_next", "single_characters", "capital_words", "marked_ends",
    "lines", "line_words", "repeated_lines",
)


def statistics_of(text: str | None) -> np.ndarray:
    """The numbers that describe a text; null counts as empty. The text is taken in pieces."""
    data = (text or "").encode()
    kinds = np.zeros(9)
    words: Counter[bytes] = Counter()
    lines: Counter[int] = Counter()
    total = letters = longest = repeated = single = capital = marked = 0
    last = None
    for piece in pieces_of(data):
        classes = _CLASS[np.frombuffer(piece, dtype=np.uint8)]
        kinds += np.bincount(classes, minlength=9)
        found = piece.split()
        if not found:
            continue
        words.update(found)
        total += len(found)
        lengths = list(map(len, found))
        letters += sum(lengths)
        longest = max(longest, max(lengths))
        single += lengths.count(1)
        repeated += (last == found[0]) + sum(map(bytes.__eq__, found, found[1:]))
        capital += sum(map(bytes.isupper, found))
        ends = np.frombuffer(b"".join([word[-1:] for word in found]), dtype=np.uint8)
        marked += int((_CLASS[ends] == _MARK).sum())
        last = found[-1]
    for line in data.split(b"\n"):
        if line := line.strip():
            lines[hash(line)] += 1
    size, n, rows = max(1, len(data)), max(1, total), max(1, sum(lines.values()))
    return np.array(
        [
            np.log1p(total),
            np.log1p(letters / n),
            np.log1p(longest),
            kinds[_UPPER] / max(1, kinds[_UPPER] + kinds[_LOWER]),
            kinds[_DIGIT] / size,
            kinds[_STOP] / size,
            kinds[_MARK] / size,
            kinds[_OTHER] / size,
            kinds[_HIGH] / size,
            np.log1p(len(words)) / np.log1p(n),
            max(words.values(), default=0) / n,
            repeated / n,
            single / n,
            capital / n,
            marked / n,
            np.log1p(sum(lines.values())),
            np.log1p(total / rows),
            1 - len(lines) / rows if lines else 0.0,
        ]
    )


def text_statistics(text: Column) -> Column:
    """`statistics_of` each text."""

    @F.arrow_udf("array<double>")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release_tables()
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([texts], ["text"])
            found = [statistics_of(one.as_py()) for part in slices(batch, 0) for one in part.column(0)]
            values = np.concatenate(found) if found else np.empty(0)
            offsets = np.arange(0, len(values) + 1, len(STATISTICS), dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

    return column(text)


@dataclass(frozen=True, eq=False)
class Fourier:
    """Standardisation and random features: fixed numbers but for the mean and deviation."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phases: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        """Rows of statistics as features, the first of them constant."""
        x = np.clip((rows - self.mean) / self.scale, -LARGEST, LARGEST)
        waves = np.cos(x @ self.weights + self.phases) * np.sqrt(2.0 / len(self.phases))
        return np.hstack([np.ones((len(rows), 1)), waves])


def fourier(mean: np.ndarray, deviation: np.ndarray, features: int = FEATURES, seed: int = SEED) -> Fourier:
    random = np.random.Generator(np.random.Philox(seed))
    weights = random.standard_normal((len(mean), features)) / WIDTH
    phases = random.uniform(0, 2 * np.pi, features)
    return Fourier(mean, np.where(deviation > 1e-9, deviation, 1.0), weights, phases)


@dataclass(frozen=True, eq=False)
class Model:
    """Features, weights of the fit, and the probabilities `values` at the scores `places`."""

    fourier: Fourier | None
    beta: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(rows), 0.5)
        raw = self.fourier.features(rows) @ self.beta
        return np.clip(np.interp(raw, self.places, self.values), 0.0, 1.0)


def isotonic(places: np.ndarray, values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing fit of `values` at ascending `places`: mean place and value of each pool."""
    pools: list[list[float]] = []  # weight, weighted sum of values, weighted sum of places
    for place, value, weight in zip(places, values, weights):
        pools.append([weight, weight * value, weight * place])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            top = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], top)]
    table = np.array(pools)
    return table[:, 2] / table[:, 0], table[:, 1] / table[:, 0]


def _rows(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(-1, len(STATISTICS))


def _normal_equations(labelled: DataFrame, own: Fourier) -> dict[int, np.ndarray]:
    """Fold -> sums of z z' and, as the last column, z y over its rows (statistics, y, fold)."""
    size = len(own.phases) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z, y = own.features(_rows(batch, 0)), batch.column(1).to_numpy()
            fold = batch.column(2).to_numpy()
            for k in np.unique(fold).tolist():
                part = z[fold == k]
                whole = np.hstack([part.T @ part, (part.T @ y[fold == k])[:, None]])
                totals[k] = totals[k] + whole if k in totals else whole
        for k, total in totals.items():
            values = pa.array(total.ravel())
            offsets = pa.array(np.arange(0, total.size + 1, size + 1, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(pa.scalar(k, pa.int32()), size),
                    pa.array(np.arange(size, dtype=np.int32)),
                    pa.ListArray.from_arrays(offsets, values),
                ],
                ["fold", "line", "total"],
            )

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(rows["total"].to_list()), axis=0)
        return pd.DataFrame({"fold": rows["fold"][:1], "line": rows["line"][:1], "total": [total]})

    schema = "fold int, line int, total array<double>"
    partial = labelled.select("statistics", "y", "fold").mapInArrow(sums, schema)
    # one row per partition for each line of a matrix
    found = partial.groupBy("fold", "line").applyInPandas(added, schema).collect()
    out = {row["fold"]: np.zeros((size, size + 1)) for row in found}
    for row in found:
        out[row["fold"]][row["line"]] = row["total"]
    return out


def _solved(total: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge weights; the constant (first) is not held back, and its own sum is the number of rows."""
    size = len(total)
    weight = np.full(size, ridge * max(1.0, total[0, 0]))
    weight[0] = 1e-9
    return np.linalg.solve(total[:, :size] + np.diag(weight), total[:, size])


def train(labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """A model from rows (statistics, y, fold): y from 0 to 1, fold from 0 to `FOLDS` - 1.

    Without a row, every text has the probability 0.5.
    """
    column = F.col("statistics")
    n = len(STATISTICS)
    found = labelled.agg(
        F.count("*").alias("rows"),
        *[F.avg(column[i]).alias(f"mean{i}") for i in range(n)],
        *[F.stddev_pop(column[i]).alias(f"deviation{i}") for i in range(n)],
    ).first()
    if not found["rows"]:
        return Model(None, np.zeros(0), np.zeros(1), np.zeros(1))
    own = fourier(
        np.array([found[f"mean{i}"] for i in range(n)]),
        np.array([found[f"deviation{i}"] for i in range(n)]),
        features,
        seed,
    )
    sums = _normal_equations(labelled, own)
    whole = sum(sums.values())
    # a fold that has all rows is scored by the fit of all
    others = {k: _solved(whole - total if len(sums) > 1 else whole, ridge) for k, total in sums.items()}

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, fold = own.features(_rows(batch, 0)), batch.column(2).to_numpy()
            raw = np.zeros(batch.num_rows)
            for k in np.unique(fold).tolist():
                raw[fold == k] = z[fold == k] @ others[k]
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column(1)], ["raw", "y"])

    raw = labelled.select("statistics", "y", "fold").mapInArrow(scored, "raw double, y double")
    place = F.greatest(F.least(F.col("raw"), F.lit(MOST)), F.lit(LEAST))
    bins = (
        raw.groupBy(F.floor(place * BINS).alias("bin"))
        .agg(F.avg(place).alias("place"), F.avg("y").alias("value"), F.count("*").alias("rows"))
        .toPandas()
        .sort_values("bin")
    )
    places, values = isotonic(
        bins["place"].to_numpy(float), bins["value"].to_numpy(float), bins["rows"].to_numpy(float)
    )
    return Model(own, _solved(whole, ridge), places, values)


def probability(statistics: Column, model: Model) -> Column:
    """The probability of label 1 for a column of `text_statistics`."""

    @F.arrow_udf("double")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            values = rows.flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.array(model.probabilities(values))

    return column(statistics)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    folds: int = FOLDS,
) -> DataFrame:
    """(doc_id, training, score) per row of `docs`; score is the probability of label 1.

    `training` says of a row of `docs` by its `doc_id` whether its label may be learnt from. Labels
    are those of the same id, the mean of repeated ones, from 0 to 1; null labels and labels without
    an id or a document teach nothing. Null texts count as empty ones, repeated rows all count. With
    no label at all every score is 0.5. An empty table gives no rows; other columns are not read.
    Sums are in floating point, so scores may differ in their last digits between two runs.
    """
    described = cut(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            text_statistics(F.col(text_column)).alias("statistics"),
        ).withColumn("training", F.coalesce(training, F.lit(False)))
    )
    marks = (
        labels.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.greatest(F.least(F.col(label_column).cast("double"), F.lit(1.0)), F.lit(0.0)).alias("y"),
        )
        .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~F.isnan("y"))
        .groupBy("doc_id")
        .agg(F.avg("y").alias("y"))
    )
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(folds)).cast("int")
    labelled = cut(
        described.filter("training").join(marks, "doc_id").select("statistics", "y", fold.alias("fold"))
    )
    model = train(labelled)
    return described.select("doc_id", "training", probability(F.col("statistics"), model).alias("score"))
