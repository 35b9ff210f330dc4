from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from tapewatch.llm.sharding import shard_rows, write_shards


def brute(rows, shards, seed):
    def narrow(row):
        doc_id, source, text = row
        data = (text or "").encode()
        key = hashlib.md5(f"{seed}:{'none' if doc_id is None else doc_id}".encode()).hexdigest()
        return doc_id, source, len(data) + 1, zlib.crc32(data), key

    def ties(row):
        doc_id, _, size, crc, key = row
        return key, doc_id is not None, doc_id or 0, crc, size

    by_source = defaultdict(list)
    for row in map(narrow, rows):
        by_source[row[1]].append(row)
    order = []
    for source, members in by_source.items():
        for rank, row in enumerate(sorted(members, key=ties)):
            order.append(((rank + 0.5) / len(members), source is not None, source or "", *ties(row), row))
    out, slots = [], Counter()
    for at, entry in enumerate(sorted(order, key=lambda e: e[:-1])):
        doc_id, source, size, crc, _ = entry[-1]
        shard = at * shards // len(order)
        out.append((doc_id, size, crc, source, shard, slots[shard]))
        slots[shard] += 1
    return sorted(out, key=str)


@pytest.mark.parametrize(("shards", "seed"), [(8, 20), (3, 1), (50, 7)])
def test_odd_documents(odd_documents, shards, seed):
    rows = [(r.doc_id, r.source, r.text) for r in odd_documents.collect()]
    found = sorted(map(tuple, shard_rows(odd_documents, shards, seed).collect()), key=str)
    assert found == brute(rows, shards, seed)


def test_every_shard_has_the_mixture(spark):
    """A source with half of the rows, one with a hundredth: each shard has its share of either."""
    sources = ["hot"] * 500 + [f"s{i % 10}" for i in range(490)] + ["rare"] * 10
    frame = spark.createDataFrame([(i, s, "text") for i, s in enumerate(sources)], "doc_id long, source string, text string")
    rows = shard_rows(frame.repartition(7), 8).collect()
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and sorted(sizes) == list(range(8))
    total = Counter(sources)
    for shard in range(8):
        here = Counter(r.source for r in rows if r.shard == shard)
        assert all(abs(here[s] - n / 8) <= 1 + 0.02 * n for s, n in total.items())
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sizes[shard]))


def test_order_does_not_depend_on_partitions(spark):
    frame = spark.createDataFrame([(i, f"s{i % 4}", str(i)) for i in range(200)], "doc_id long, source string, text string")
    assert sorted(shard_rows(frame.repartition(1)).collect()) == sorted(shard_rows(frame.repartition(9)).collect())


def test_no_documents(no_documents):
    assert shard_rows(no_documents).collect() == []


def test_write_shards(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"s{i % 4}", str(i)) for i in range(40)], "doc_id long, source string, text string")
    write_shards(frame, shard_rows(frame, 4), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 40 and back.select("shard").distinct().count() == 4
    assert back.select(frame.columns).exceptAll(frame).isEmpty()
