from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from tapewatch.llm import exact_dedup, support
from tapewatch.llm.exact_dedup import exact_duplicates


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = min(named, default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        taken = False
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, keep, len(ids), not taken and i == keep, digest))
            taken = taken or i == keep
    return sorted(out, key=str)


def result(frame, **options):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, exact_duplicates(frame, **options).select(columns).collect()), key=str)


@pytest.mark.parametrize("block", [3, 64, 2048])
def test_odd_documents(odd_documents, block):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert result(odd_documents, block_bytes=block) == brute(rows)


def test_no_documents(no_documents):
    assert result(no_documents) == []


def test_frequent_blocks_are_named_apart(spark):
    """Copies beyond the limit for frequent blocks, next to texts that share all but one block."""
    random.seed(1)
    body = "".join(random.choice("abcd ") for _ in range(40))
    rows = [(i, body) for i in range(100)] + [(200 + i, body + str(i % 60)) for i in range(120)]
    rows += [(400 + i, str(i % 50) + body[2:]) for i in range(80)]
    assert exact_dedup.HOT_ROWS < 100
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(frame, block_bytes=8) == brute(rows)


def test_all_bytes_decide(spark):
    """Equal prefixes, equal lengths, swapped blocks."""
    texts = ["aabb" * 9, "bbaa" * 9, "aabb" * 8 + "aabc", "aabb" * 8, "abab" * 9, "aabb" * 9]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(frame, block_bytes=2) == brute(rows)


def test_rows_find_their_group_hot_or_not(spark, monkeypatch):
    """Two groups are broadcast, the others are joined; ties and single rows lose nothing."""
    monkeypatch.setattr(support, "HOT_KEYS", 2)
    sizes = {("a", 1): 40, ("a", 2): 30, ("b", 1): 30, ("b", 2): 3, ("c", 1): 1, ("c", 2): 1}
    keys = [key for key, size in sizes.items() for _ in range(size)]
    rows = spark.createDataFrame([(*key, at) for at, key in enumerate(keys)], "x string, y int, at int")
    groups = spark.createDataFrame([(*key, size) for key, size in sizes.items()], "x string, y int, size int")
    found = support.with_group(rows, groups, ["x", "y"], "size")
    assert found.columns == ["x", "y", "at", "size"]
    assert sorted(map(tuple, found.collect())) == sorted((*key, at, sizes[key]) for at, key in enumerate(keys))
    nothing = support.with_group(rows.limit(0), groups.limit(0), ["x", "y"], "size")
    assert nothing.collect() == []
