from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from tapewatch.llm import phrases

SCHEMA = "lang string, text string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, min_count=10, per_language=2000):
    counts = defaultdict(Counter)
    total = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= min_count}
        scored = []
        for phrase, a in candidates.items():
            if any(len(q) > len(phrase) and (q[:2] == phrase or q[1:] == phrase) and 100 * b >= 50 * a for q, b in candidates.items()):
                continue
            cuts = []
            for k in range(1, len(phrase)):
                left, right = own[phrase[:k]], own[phrase[k:]]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:per_language], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def found(spark, rows, **options):
    frame = phrases.collocations(spark.createDataFrame(rows, SCHEMA), **options)
    assert frame.columns == COLUMNS
    return sorted(tuple(row) for row in frame.collect())


def texts(seed, documents=120, vocabulary=30):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "ÀB", "New", "York", "漢字", "  ", "\t", "x."]
    rows = []
    for i in range(documents):
        chosen = [words[min(int(rng.expovariate(0.15)), len(words) - 1)] for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 4)):
            chosen.insert(rng.randint(0, len(chosen)), rng.choice(["New York City", "of the", "a\tB c"]))
        rows.append((["en", "fr", None, "und"][i % 4], rng.choice([" ", ", ", "\n"]).join(chosen)))
    return rows


@pytest.mark.parametrize("options", [{}, {"sample_of": 10**9}, {"sample_of": 1}, {"sample_of": 3, "sample_count": 30}])
def test_equals_brute_force_whatever_the_sample(spark, options):
    rows = texts(1)
    expected = brute(rows)
    assert len(expected) > 20
    assert found(spark, rows, **options) == expected


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MAX_FILTER_BITS", 64)
    rows = texts(2, documents=60)
    assert found(spark, rows) == brute(rows)


def test_texts_that_are_cut_into_chunks(spark):
    rng = random.Random(3)
    words = ["aa", "b", "cc,", "New York", "dd.", "  ee\t", "ff\n", "y" * 70]
    rows = [("en", " ".join(rng.choice(words) for _ in range(3000))), ("en", "z" * 500), ("fr", "aa b " * 400)]
    for size in (1, 7, 1000):
        assert found(spark, rows, chunk_bytes=size) == brute(rows)


def test_ranks_are_cut_and_ties_go_by_bytes(spark):
    rows = [("en", ". ".join(["é è", "y x", "a z", "b c"] * 10))]
    assert found(spark, rows, per_language=3) == brute(rows, per_language=3)
    assert [row[2] for row in found(spark, rows)] == ["a z", "b c", "y x", "é è"]


def test_odd_rows(spark, odd_documents, no_documents):
    rows = [(row.lang, row.text) for row in odd_documents.collect()]
    frame = phrases.collocations(odd_documents)
    assert sorted(tuple(row) for row in frame.collect()) == brute(rows)
    assert phrases.collocations(no_documents).collect() == []
    assert found(spark, [(None, None), ("en", ""), ("en", " . ")]) == []


def test_products_beyond_64_bits(spark):
    a, left, right = 4 * 10**12, 5 * 10**12, 6 * 10**12
    schema = "lang string, size int, phrase string, n long"
    rows = [("en", 2, "x y", a), ("en", 1, "x", left), ("en", 1, "y", right)]
    counts = spark.createDataFrame(rows, schema)
    scored = phrases._scored(counts.filter("size = 2"), counts.filter("size < 2")).first()
    assert scored.score == 1_000_000 * a * a // (left * right)
