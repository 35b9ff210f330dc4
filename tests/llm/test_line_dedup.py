from __future__ import annotations

from collections import Counter

from tapewatch.llm.line_dedup import drop_boilerplate


def brute(rows, share, pages):
    """(id, host, text) -> the same with boilerplate lines gone."""
    counts, totals = Counter(), Counter()
    for _, host, text in rows:
        totals[host] += 1
        if text is not None:
            counts.update((host, line) for line in {x.strip(" \t\r") for x in text.split("\n")} if line)
    gone = {key for key, n in counts.items() if n >= pages and n > totals[key[0]] * share}
    return [
        (i, host, None if text is None else "\n".join(x for x in text.split("\n") if (host, x.strip(" \t\r")) not in gone))
        for i, host, text in rows
    ]


def rows_of(frame, column="text"):
    return sorted(((r.doc_id, r.source, r[column]) for r in frame.collect()), key=str)


def test_odd_documents(odd_documents):
    rows = [(r.doc_id, r.source, r.text) for r in odd_documents.collect()]
    found = drop_boilerplate(odd_documents, max_share=0.1, min_pages=2)
    assert found.columns == odd_documents.columns
    expected = brute(rows, 0.1, 2)
    assert rows_of(found) == sorted(expected, key=str)
    assert sorted(expected, key=str) != sorted(rows, key=str)


def test_counts_and_threshold(spark):
    head = "Subscribe now"
    rows = [(i, "a", f"{head} \nbody {i}\n\n{head}") for i in range(5)]
    rows += [(10 + i, "a", f"body {i} b") for i in range(95)]  # exactly 5 % in a: kept
    rows += [(200 + i, "b", f"{head}\nbody {i}") for i in range(3)] + [(300 + i, "b", "") for i in range(20)]
    rows += [(400, "c", head), (401, "c", head)]  # too few pages
    rows += [(500 + i, None, head) for i in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = drop_boilerplate(frame, kept_text="kept", counts=("lines", "gone"))
    assert rows_of(found, "kept") == sorted(brute(rows, 0.05, 3), key=str)
    by_id = {r.doc_id: r for r in found.collect()}
    assert (by_id[0].kept, by_id[0].lines, by_id[0].gone) == (f"{head} \nbody 0\n\n{head}", 4, 0)
    assert (by_id[200].kept, by_id[200].lines, by_id[200].gone) == ("body 0", 2, 1)
    assert by_id[400].kept == head
    assert (by_id[500].kept, by_id[500].gone) == ("", 1)
    assert found.select("doc_id", "source", "text").exceptAll(frame).isEmpty()


def test_no_documents(no_documents):
    assert drop_boilerplate(no_documents).collect() == []


def test_main_path_has_no_python(odd_documents):
    plan = drop_boilerplate(odd_documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
