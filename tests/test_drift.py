"""Checks of what arrives: injected drift and nulls, against plain Python."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tapewatch.operators import drift

LAYOUT = "event_timestamp timestamp_ntz, symbol string, option_type string, volume int, open_interest int, implied_volatility double, strike double, source string"
START = datetime(2026, 5, 1)
BAD_DAY, NULL_DAY = 8, 10


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(11)
    found = []
    for day in range(12):
        for _ in range(400):
            volume = pick.choice([3, 40, 300, 3000])
            if day == BAD_DAY:
                volume *= 20
            symbol = pick.choice(["HOT", "HOT", "A", "B"])
            if day == NULL_DAY and pick.random() < 0.5:
                symbol = None
            time = START + timedelta(days=day, minutes=pick.randrange(1440))
            found.append((time, symbol, pick.choice(["CALL", "PUT"]), volume, 700, 0.3, 75.0, "s"))
    return found


def test_injected_drift_is_found_and_nothing_else(spark, rows):
    # of a drifted day a seventh is in the base of the days after it, too little for them to drift
    checks = drift.daily_checks(drift.daily_profile(spark.createDataFrame(rows, LAYOUT)), days=7).collect()
    found = {((row.event_date - START.date()).days, row.field) for row in checks if row.drifted}
    assert found == {(BAD_DAY, "volume"), (NULL_DAY, "symbol")}
    nulls = {(row.event_date - START.date()).days: row.nulls for row in checks if row.field == "symbol"}
    assert nulls[NULL_DAY] > 150 and sum(nulls.values()) == nulls[NULL_DAY]


def test_distances_equal_plain_python(spark, rows):
    pick = random.Random(2)
    some = [row for row in rows if pick.random() < 0.02 and row[0].day != 4]
    checks = drift.daily_checks(drift.daily_profile(spark.createDataFrame(some, LAYOUT)), days=3, min_rows=1).collect()
    for row in checks:
        if row.field != "symbol":
            continue
        today = Counter(r[1] for r in some if r[0].date() == row.event_date)
        past = Counter(r[1] for r in some if timedelta(0) < row.event_date - r[0].date() <= timedelta(3))
        a, b = sum(today.values()), sum(past.values())
        assert (row.rows, row.base_rows) == (a, b)
        if not b:
            assert row.distance_per_million is None and not row.drifted
            continue
        apart = sum(abs(Fraction(today[k], a) - Fraction(past[k], b)) for k in {*today, *past}) / 2
        assert row.distance_per_million == int(apart * 1_000_000)


def test_profiles_of_parts_add_up(spark, rows):
    whole = drift.daily_profile(spark.createDataFrame(rows, LAYOUT))
    parts = [drift.daily_profile(spark.createDataFrame(part, LAYOUT)) for part in (rows[:1000], rows[1000:])]
    merged = drift.merged_profiles(parts[0].union(parts[1]))
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, whole.collect()))


def test_bins_nulls_and_no_events(spark):
    nan = float("nan")
    odd = [(None, None, None, None, 0, nan, -1.0, None), (START, "A", "X", -5, 100, 0.1, 1e12, None)]
    found = {(r.event_date, r.field): r.bin for r in drift.daily_profile(spark.createDataFrame(odd, LAYOUT)).collect()}
    day = START.date()
    assert found[None, "volume"] is None and found[None, "implied_volatility"] == "8" and found[None, "strike"] == "0"
    assert (found[day, "volume"], found[day, "open_interest"], found[day, "implied_volatility"]) == ("0", "3", "2")
    none = spark.createDataFrame([], LAYOUT)
    assert drift.daily_checks(drift.daily_profile(none)).collect() == []


def test_freshness(spark, rows):
    late = [(START + timedelta(days=2), *rows[0][1:-1], "old"), (None, *rows[0][1:-1], "never")]
    events = spark.createDataFrame([*rows, *late], LAYOUT)
    now = F.lit("2026-05-13 00:00:00").cast("timestamp_ntz")
    found = {r.source: (r.age_seconds, r.stale) for r in drift.freshness(events, now, 86400).collect()}
    assert found["old"] == (10 * 86400, True) and found["never"] == (None, True) and not found["s"][1]
