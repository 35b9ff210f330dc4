"""The five stages of the corpus pipeline, each on odd and empty tables and all on the small table."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as pipeline
from tapewatch.llm import decontaminate, language, line_dedup
from tapewatch.llm.queries import held_out

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(pipeline.STAGES)


def rows(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.mark.parametrize("name", list(STAGES))
def test_odd_and_empty_tables(spark, odd_documents, no_documents, name):
    found = STAGES[name](spark, odd_documents, FOLDER)
    assert STAGES[name](spark, no_documents, FOLDER).collect() == []
    if name == "byte_bpe":
        assert found.count() == odd_documents.count() and found.filter("not exact").isEmpty()
        return
    assert found.columns == odd_documents.columns
    before = Counter((row.doc_id, row.source) for row in odd_documents.collect())
    assert not Counter((row.doc_id, row.source) for row in found.collect()) - before


def test_without_n_chars(spark, odd_documents):
    docs = odd_documents.drop("n_chars")
    assert STAGES["line_dedup"](spark, docs, FOLDER).columns == docs.columns


def plain_lines(docs):
    """Documents without the lines that stand on over 5 % and on enough of their source's documents."""
    totals, pages = Counter(d["source"] for d in docs), defaultdict(Counter)
    for doc in docs:
        lines = {line.strip(" \t\r") for line in (doc["text"] or "").split("\n")} - {""}
        pages[doc["source"]].update(lines)
    out = []
    for doc in docs:
        own, total = pages[doc["source"]], totals[doc["source"]]
        drop = {x for x, n in own.items() if n >= line_dedup.MIN_PAGES and n > total * line_dedup.MAX_SHARE}
        text = doc["text"]
        if text is not None:
            text = "\n".join(line for line in text.split("\n") if line.strip(" \t\r") not in drop)
        out.append(dict(doc, text=text, n_chars=None if text is None else len(text)))
    return out


def test_stages_follow_each_other(spark):
    """Each stage's rows from those before it, by plain Python or the operator's own pairs."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    model = language.train(docs.filter(~held_out(docs.doc_id)))
    scorer = language.Scorer(model)
    told = {}
    for row in docs.collect():
        lang, score = scorer.predict(row.text)
        if lang != "und" and score >= pipeline.MIN_LANGUAGE_SCORE:
            told[row.doc_id] = row.asDict()
    kept = STAGES["language_id"](spark, docs, FOLDER)
    assert rows(kept) == Counter(tuple(row[c] for c in columns) for row in told.values())
    # clean documents stay: all that have a label and a letter
    assert len(told) >= 0.99 * docs.filter("text rlike '[a-z]'").count()

    lines = STAGES["line_dedup"](spark, kept, FOLDER)
    assert rows(lines) == Counter(tuple(row[c] for c in columns) for row in plain_lines(list(told.values())))

    near = STAGES["simhash"](spark, lines, FOLDER)
    ids = {row.doc_id for row in near.collect()}
    texts = defaultdict(list)
    for row in lines.collect():
        texts[hashlib.sha256((row.text or "").encode()).hexdigest()].append(row.doc_id)
    assert all(len(ids & set(same)) <= 1 for same in texts.values())
    assert ids <= {min(same) for same in texts.values()} and rows(near) <= rows(lines)

    clean = STAGES["decontamination"](spark, near, FOLDER)
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    bad = {row.doc_id for row in decontaminate.contaminated_pairs(near, benchmark).collect()}
    assert rows(clean) == rows(near.filter(~near.doc_id.isin(list(bad))))

    tokens = STAGES["byte_bpe"](spark, clean, FOLDER)
    assert tokens.filter("not exact").isEmpty() and {r.doc_id for r in tokens.collect()} == ids - bad
    assert rows(pipeline.run(spark, FOLDER).select("doc_id", "n_tokens")) == rows(tokens.select("doc_id", "n_tokens"))
