"""Baselines against plain Python; stored history under replays and corrections."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import date, timedelta
from fractions import Fraction
from pathlib import Path

import pytest

from tapewatch.operators import baseline
from tapewatch.plans import history

LAYOUT = "event_id string, contract_symbol string, event_date date, volume int"
START = date(2026, 3, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, LAYOUT)


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(5)
    found = []
    for i in range(600):
        # a third of the events on one contract; one contract with equal volumes
        contract = "HOT" if i % 3 == 0 else pick.choice(["A", "B", "FLAT", "RARE" if i % 50 == 1 else "B"])
        volume = 70 if contract == "FLAT" and i < 560 else pick.choice([0, 5, 900, 2**31 - 1, pick.randrange(5000)])
        found.append((f"e{i}", contract, START + timedelta(days=pick.randrange(40)), volume))
    return found


def plain(rows, days, min_events, limit):
    by_key = defaultdict(list)
    for _, contract, day, volume in rows:
        by_key[contract].append((day, volume))
    out = {}
    for event_id, contract, day, volume in rows:
        past = [v for d, v in by_key[contract] if timedelta(0) < day - d <= timedelta(days)]
        score, above = None, False
        if past:
            mean = Fraction(sum(past), len(past))
            variance = sum((v - mean) ** 2 for v in past) / len(past)
            if variance:
                score = float(volume - mean) / math.sqrt(variance)
            enough = len(past) >= min_events
            above = enough and (volume > mean if score is None else score >= limit)
        out[event_id] = (len(past), score, above)
    return out


@pytest.mark.parametrize(("days", "min_events", "limit"), [(20, 3, 1.2), (1, 1, 0.5), (39, 30, 0.9)])
def test_scores_equal_plain_python(spark, rows, days, min_events, limit):
    events = frame(spark, rows)
    found = baseline.against_baseline(
        events, baseline.daily_moments(events), days=days, min_events=min_events, limit=limit
    ).collect()
    expected = plain(rows, days, min_events, limit)
    assert len(found) == len(rows) and any(r.above_baseline for r in found)
    for row in found:
        n, score, above = expected[row.event_id]
        assert (row.base_n, row.above_baseline) == (n, above)
        assert (row.z_score is None) == (score is None)
        if score is not None:
            assert row.z_score == pytest.approx(score, abs=0.0001)


def test_moments_of_parts_add_up(spark, rows):
    whole = baseline.daily_moments(frame(spark, rows))
    parts = baseline.daily_moments(frame(spark, rows[:200])).union(baseline.daily_moments(frame(spark, rows[200:])))
    merged = baseline.merged_moments(parts)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))


def files(folder):
    return {str(f): f.read_bytes() for f in Path(folder).glob("event_date=*/*.parquet")}


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_a_replayed_day_changes_nothing_and_a_correction_only_its_day(spark, rows, tmp_path, mode):
    folder, day = f"{tmp_path}/h", START + timedelta(days=4)
    of_day = [row for row in rows if row[2] == day]
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        history.update_history(frame(spark, rows), folder)
        first, stored = files(folder), sorted(map(tuple, history.read_history(spark, folder).collect()))
        history.update_history(frame(spark, of_day), folder)
        assert sorted(map(tuple, history.read_history(spark, folder).collect())) == stored
        history.update_history(frame(spark, [*of_day, ("new", "NEW", day, 9)]), folder)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    now = sorted(map(tuple, history.read_history(spark, folder).collect()))
    assert [row for row in now if row not in stored] == [("NEW", 1, 9, 81, day)]
    untouched = {name for name in first if f"event_date={day}" not in name}
    assert untouched and all(files(folder)[name] == first[name] for name in untouched)


def test_only_days_asked_for_are_read(spark, rows, tmp_path):
    history.update_history(frame(spark, rows), f"{tmp_path}/h")
    some = history.read_history(
        spark, f"{tmp_path}/h", first=START + timedelta(days=2), last=START + timedelta(days=3)
    )
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert {row.event_date for row in some.collect()} == {START + timedelta(days=2), START + timedelta(days=3)}


def test_nulls_and_no_events(spark):
    odd = frame(spark, [("a", "A", None, 5), ("b", "A", START, None), ("c", None, START, 4), ("d", "A", START, 4)])
    moments = baseline.daily_moments(odd)
    assert sorted((str(r.contract_symbol), r.n) for r in moments.collect()) == [("A", 1), ("None", 1)]
    found = {r.event_id: (r.base_n, r.above_baseline) for r in baseline.against_baseline(odd, moments).collect()}
    assert found == {"a": (None, False), "b": (0, False), "c": (None, False), "d": (0, False)}
    none = frame(spark, [])
    assert baseline.against_baseline(none, baseline.daily_moments(none)).collect() == []
