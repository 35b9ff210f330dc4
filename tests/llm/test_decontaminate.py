from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tapewatch.llm import decontaminate
from tapewatch.llm.decontaminate import alignment, contaminated_pairs, with_contamination


def plain_alignment(item, passage):
    """Smith-Waterman cell by cell: the best score."""
    table = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            fit = 2 if a == b and a >= 0 else -1
            table[i][j] = max(0, table[i - 1][j - 1] + fit, table[i - 1][j] - 1, table[i][j - 1] - 1)
    return max(map(max, table), default=0)


def words_of(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())


def brute(docs, items, least):
    """All documents against all items, whole against whole."""
    out = []
    for doc_id, text in docs:
        for item_id, item in items:
            words = words_of(item)
            if words:
                number = {w: n for n, w in enumerate(dict.fromkeys(words))}
                ids = [number.get(w, -1) for w in words_of(text)]
                score = plain_alignment([number[w] for w in words], ids) / (2 * len(words))
                if score >= least:
                    out.append((doc_id, item_id, round(score, 9)))
    return sorted(out, key=str)


def pairs(docs, benchmark, **options):
    rows = contaminated_pairs(docs, benchmark, **options).collect()
    return sorted(((r.doc_id, r.item_id, round(r.score, 9)) for r in rows), key=str)


def test_alignment_equals_cell_by_cell():
    random.seed(2)
    for _ in range(200):
        item = np.array([random.randrange(6) for _ in range(random.randrange(1, 12))])
        passage = np.array([random.randrange(-1, 6) for _ in range(random.randrange(0, 25))], dtype=np.int64)
        share, first, last = alignment(item, passage)
        assert share * 2 * len(item) == plain_alignment(item.tolist(), passage.tolist())
        if share:
            assert 0 <= first <= last < len(passage)
            alone, begin, end = alignment(item, passage[first : last + 1])
            assert (alone, begin, end) == (share, 0, last - first)


@pytest.fixture(scope="module")
def planted(spark):
    random.seed(4)
    words = [f"w{i}" for i in range(40)] + ["the", "of"] * 10
    items = [(i, " ".join(random.choice(words) for _ in range(random.randrange(12, 40))).capitalize() + ".") for i in range(20)]
    docs = []
    for i in range(120):
        text = [random.choice(words) for _ in range(random.randrange(20, 150))]
        if i % 3 == 0:
            item = items[i % 20][1].upper().rstrip(".").split() if i % 2 else items[i % 20][1].split()
            for _ in range(i % 5):  # edits: a word replaced, dropped or added
                at = random.randrange(len(item))
                item[at : at + random.choice([0, 1])] = random.choice([["new"], [], ["new", "one"]])
            at = random.randrange(len(text))
            text[at:at] = item
        docs.append((i, " ".join(text)))
    docs += [(200 + i, "Before. " + items[0][1] + " After it.") for i in range(60)]  # leaked into a third
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        docs,
        items,
    )


@pytest.mark.parametrize("block_words", [400_000, 50])
def test_planted_copies(planted, block_words):
    docs, benchmark, rows, items = planted
    expected = brute(rows, items, 0.6)
    assert len(expected) > 90
    assert pairs(docs, benchmark, block_words=block_words) == expected


def test_span_is_where_the_item_stands(planted):
    docs, benchmark, rows, items = planted
    whole = {r.doc_id: r for r in contaminated_pairs(docs, benchmark).filter("item_id = 0 and doc_id >= 200").collect()}
    assert len(whole) == 60
    assert all((r.first_word, r.last_word) == (1, len(words_of(items[0][1]))) and r.score == 1 for r in whole.values())


def test_odd_documents(spark, odd_documents):
    items = [(1, "same text here same line"), (1, "same text here same line"), (2, None), (3, ""), (4, "A!"), (None, "no id here"), (5, "...")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    marked = with_contamination(odd_documents, benchmark)
    assert marked.columns == [*odd_documents.columns, "matches"] and marked.count() == odd_documents.count()
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    least = [p for p in brute(rows, sorted(set(items), key=str), 0.6)]
    # an item below the length of an n-gram must stand word for word
    assert pairs(odd_documents, benchmark) == least
    with pytest.raises(ValueError, match="matches"):
        with_contamination(marked, benchmark)


def test_nothing_to_find(spark, odd_documents, no_documents):
    benchmark = spark.createDataFrame([(1, "a test item of some words")], "item_id long, text string")
    assert contaminated_pairs(no_documents, benchmark).collect() == []
    assert contaminated_pairs(odd_documents, benchmark.limit(0)).collect() == []
    assert {len(r.matches) for r in with_contamination(odd_documents, benchmark.limit(0)).collect()} == {0}


def test_rarest_grams_are_seeds(planted):
    docs, _, rows, items = planted
    block = decontaminate._with_seeds(docs, "text", decontaminate._block(items), 2)
    per_item = {item: 0 for item in range(len(items))}
    for places in block.seeds.values():
        for item in {item for item, _ in places}:
            per_item[item] += 1
    assert set(per_item.values()) <= {0, 1, 2}
    assert per_item[0] == 2  # the item that a third of all documents have keeps its seeds


def edited(words, kind):
    """A copy of `words` with spread edits or cut ends."""
    if kind == "whole":
        return list(words)
    if kind == "cut":
        return words[len(words) // 6 : -(len(words) // 8)]
    if kind == "inserted":  # no three words in a row are left
        return [w for at, word in enumerate(words, 1) for w in ([word, "added"] if at % 2 == 0 else [word])]
    every = int(kind)
    return [f"new{at}" if at % every == 0 else word for at, word in enumerate(words, 1)]


@pytest.mark.parametrize("least", [0.6, 0.45])
def test_edited_copies_beside_whole_ones(spark, least):
    random.seed(8)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of"] * 20
    lengths = [40, 45, 50, 55, 59, 48, 3, 4, 5, 6, 7]
    items = [(i, " ".join(random.choice(vocabulary) for _ in range(n))) for i, n in enumerate(lengths)]
    docs = []
    for _, text in items:
        for kind in ["whole", "whole", "4", "5", "6", "7", "inserted", "cut"]:
            around = [random.choice(vocabulary) for _ in range(40)]
            docs.append((len(docs), " ".join(around[:20] + edited(text.split(), kind) + around[20:])))
    expected = brute(docs, items, least)
    assert len(expected) >= 7 * 6
    found = pairs(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        min_score=least,
    )
    assert found == expected


def test_items_of_one_and_two_words_follow_the_same_rule(spark):
    """A gap costs a match, whatever the item's length."""
    docs = [(1, "see alpha new beta here"), (2, "alpha beta"), (3, "beta alpha"), (4, "alpha x y beta"), (5, "gamma!"), (6, None)]
    items = [(10, "alpha beta"), (11, "Gamma")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.contaminated_pairs(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.score) for r in found} == {(1, 10, 0.75), (2, 10, 1.0), (5, 11, 1.0)}


def test_many_blocks_are_cut_into_stages(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCKS_AT_ONCE", 2)
    items = [(i, f"item number w{i} has some words of its own v{i} here") for i in range(12)]
    docs = [(i, f"before it, item number w{i} has some words of its own v{i} here and after") for i in range(0, 12, 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    marked = decontaminate.with_contamination(frame, table, block_words=12)
    assert {(r.doc_id, m.item) for r in marked.collect() for m in r.matches if m.score == 1} == {(i, i) for i in range(0, 12, 3)}
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 2
