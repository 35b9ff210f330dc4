from __future__ import annotations

import random

import pytest
import xxhash

from tapewatch.llm.components import connected_components
from tapewatch.llm.simhash import ball, near_links, simhash_components, text_fingerprint
from tapewatch.llm.support import signed


def plain_fingerprint(text, words=4):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def classes(prints, links):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in prints}


def brute(rows, max_bits):
    prints = [(i, plain_fingerprint(text)) for i, text in rows]
    distinct = sorted({p for _, p in prints})
    links = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= max_bits]
    of = classes(distinct, links)
    smallest = {}
    for i, p in prints:
        if i is not None:
            smallest[of[p]] = min(smallest.get(of[p], i), i)
    return sorted(((i, f"{p:016x}", smallest.get(of[p])) for i, p in prints), key=str)


@pytest.mark.parametrize("text", [None, "", " \n", "one", "a b c", "A b C d", "a b c d e " * 400, "x\x85y z w É é"])
def test_fingerprint(text):
    assert text_fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_a_long_text():
    random.seed(3)
    text = " ".join(str(random.randrange(10**6)) for _ in range(400_000))  # several pieces
    assert text_fingerprint(text) == plain_fingerprint(text)


def test_odd_documents(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    found = sorted(map(tuple, simhash_components(odd_documents).collect()), key=str)
    assert found == brute(rows, 4)


def test_no_documents(no_documents):
    assert simhash_components(no_documents).collect() == []


def test_near_copies(spark):
    random.seed(5)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for group in range(12):
        text = [random.choice(words) for _ in range(300)]
        for copy in range(6):
            changed = list(text)
            for _ in range(copy):
                changed[random.randrange(300)] = random.choice(words)
            rows.append((len(rows), " ".join(changed)))
    expected = brute(rows, 4)
    assert len({c for *_, c in expected}) < len(rows)
    found = simhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found), key=str) == expected


@pytest.mark.parametrize("max_bits", [0, 2, 4, 6])
def test_links_join_all_within_the_distance(spark, max_bits):
    """Chains of flipped bits in one half, in both, and in the sign bit."""
    random.seed(max_bits)
    prints = {0, 2**64 - 1}
    for _ in range(25):
        at = random.getrandbits(64)
        for _ in range(8):
            prints.add(at)
            for bit in random.sample(range(random.choice([8, 64])), random.choice([1, 2, 3, 4, 5])):
                at ^= 1 << bit
    frame = spark.createDataFrame([(signed(p),) for p in prints], "f long")
    found = [(r.a % 2**64, r.b % 2**64) for r in near_links(frame, max_bits).collect()]
    assert all((a ^ b).bit_count() <= max_bits for a, b in found)
    wanted = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= max_bits]
    assert classes(prints, found) == classes(prints, wanted)


def test_ball_and_odd_distance(spark):
    assert len(ball(64, 2)) == 2081 and len(set(ball(64, 2))) == 2081 and len(ball(32, 1)) == 33
    with pytest.raises(ValueError, match="even"):
        near_links(spark.createDataFrame([(1,)], "f long"), 3)


def test_components(spark):
    random.seed(9)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(40)] + [(7, 7), (300, 200), (200, 300)]
    links += [(random.randrange(400, 500), random.randrange(400, 500)) for _ in range(60)]
    random.shuffle(links)
    frame = spark.createDataFrame(links, "a long, b long")
    nodes = {n for a, b in links if a != b for n in (a, b)}
    found = {r.node: r.component for r in connected_components(frame).collect()}
    assert found == {n: c for n, c in classes(nodes, [x for x in links if x[0] != x[1]]).items()}
    assert connected_components(frame.limit(0)).collect() == []
