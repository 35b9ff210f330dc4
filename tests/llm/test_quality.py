from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapewatch.llm import quality

DOCS = "doc_id long, text string"
LABELS = "doc_id long, quality int"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_held_out_accuracy(spark, size):
    from tapewatch.llm.queries import op13_quality

    folder = f"/root/testdata/{size}"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op13_quality(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
    out = [r for r in rows if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in out)
    assert right >= 0.97 * len(out)


def test_statistics_do_not_depend_on_pieces(monkeypatch):
    text = "Ab c. dé 12 !! " * 50 + "\nline two\nline two\n" + "ABC! " * 9
    whole = quality.statistics_of(text)
    pieces_of = quality.pieces_of
    monkeypatch.setattr(quality, "pieces_of", lambda data: pieces_of(data, 10))
    assert quality.statistics_of(text) == pytest.approx(whole)
    assert len(whole) == len(quality.STATISTICS)


@pytest.mark.parametrize("text", [None, "", " ", "\n\n", "x", "\x00", "漢字", "word " * 200_000])
def test_odd_texts_have_finite_statistics(text):
    assert np.isfinite(quality.statistics_of(text)).all()
    assert quality.statistics_of(None).tolist() == quality.statistics_of("").tolist()


def brute_isotonic(values, weights):
    """The min-max formula of isotonic regression."""
    n = len(values)
    mean = lambda a, b: np.average(values[a : b + 1], weights=weights[a : b + 1])
    return [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


def test_isotonic_equals_the_min_max_formula():
    random = np.random.default_rng(1)
    for _ in range(20):
        values, weights = random.integers(0, 3, 12) / 2, random.integers(1, 5, 12).astype(float)
        places, fitted = quality.isotonic(np.arange(12.0), values, weights)
        assert (np.diff(fitted) > 0).all() and (np.diff(places) > 0).all()
        expected = brute_isotonic(values, weights)
        assert sorted(set(np.round(expected, 9))) == pytest.approx(fitted.tolist())


def test_fit_equals_ridge_on_all_rows_at_once(spark):
    """Sums over partitions and folds give the same weights as one matrix of all rows."""
    random = np.random.default_rng(2)
    x = random.normal(size=(300, len(quality.STATISTICS)))
    y = (x[:, 0] + 0.3 * random.normal(size=300) > 0).astype(float)
    rows = [(row.tolist(), float(label), i % quality.FOLDS) for i, (row, label) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(rows, "statistics array<double>, y double, fold int").repartition(7)
    model = quality.train(frame, features=24)
    own = quality.fourier(x.mean(axis=0), x.std(axis=0), 24)
    z = own.features(x)
    held = np.full(25, quality.RIDGE * 300)
    held[0] = 1e-9
    assert model.beta == pytest.approx(np.linalg.solve(z.T @ z + np.diag(held), z.T @ y), rel=1e-6, abs=1e-6)
    # random features stand for a Gaussian kernel
    many = quality.fourier(x.mean(axis=0), x.std(axis=0), 20_000)
    waves = many.features(x[:5])[:, 1:]
    scaled = np.clip((x[:5] - many.mean) / many.scale, -quality.LARGEST, quality.LARGEST)
    apart = ((scaled[:, None] - scaled[None]) ** 2).sum(axis=2)
    assert waves @ waves.T == pytest.approx(np.exp(-apart / (2 * quality.WIDTH**2)), abs=0.03)


def scores(spark, docs, labels):
    frame = quality.quality_scores(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), F.col("doc_id") < 1000
    )
    return frame.collect()


def test_labels_of_rows_outside_training_teach_nothing(spark):
    docs = [(i, "clean words in a row" if i % 2 else "X!! X!! X!!") for i in range(40)]
    docs += [(1000 + i, "clean words in a row") for i in range(5)]
    labels = [(i, i % 2) for i in range(40)]
    plain = {r.doc_id: r.score for r in scores(spark, docs, labels)}
    more = {r.doc_id: r.score for r in scores(spark, docs, labels + [(1000 + i, 0) for i in range(5)])}
    assert plain == pytest.approx(more, abs=1e-9)
    assert plain[1] > 0.9 and plain[0] < 0.1 and plain[1000] == pytest.approx(plain[1])


def test_missing_repeated_and_odd_labels(spark):
    docs = [(1, "a b"), (2, None), (None, "no id"), (3, ""), (3, "same id"), (3, "same id")]
    labels = [(1, 1), (1, 0), (2, None), (None, 1), (77, 1), (3, 5), (3, -2)]
    found = scores(spark, docs, labels)
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert [r.training for r in found if r.doc_id is None] == [False]
    assert {r.score for r in scores(spark, docs, [])} == {0.5}
    assert scores(spark, [], labels) == []
    one_class = scores(spark, [(i, "same") for i in range(9)], [(i, 1) for i in range(9)])
    assert all(r.score == pytest.approx(1) for r in one_class)


def test_odd_documents(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(i, i % 2) for i in range(16)], LABELS)
    found = quality.quality_scores(odd_documents, labels, F.col("doc_id") >= 0)
    assert found.columns == ["doc_id", "training", "score"]
    assert found.count() == odd_documents.count()
    assert quality.quality_scores(no_documents, labels, F.lit(True)).count() == 0
