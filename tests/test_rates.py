"""Quarantine rates on the stream against the batch form, late rows and spikes."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest
from helpers import event, lines_frame

from tapewatch.streaming import rates
from tapewatch.streaming.consumer import read_stream


def at(hour, minute=0, **changes):
    return event(event_timestamp=f"2026-10-06T{hour:02d}:{minute:02d}:00", **changes)


def deliver(root, name, rows):
    (root / "in").mkdir(exist_ok=True)
    text = "\n".join(row if isinstance(row, str) else json.dumps(row) for row in rows) + "\n"
    (root / name).write_text(text)
    (root / name).rename(root / "in" / name)


def run(spark, root, max_files=1, **options):
    stream = read_stream(spark, f"{root}/in", max_files)
    query = rates.start_rates(stream, f"{root}/out", f"{root}/check", **options)
    query.awaitTermination(120)
    assert query.exception() is None


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def mixed():
    pick = random.Random(3)
    found: list = []
    for i in range(120):
        changes = {"source": pick.choice(["a", "b", "a", None]), "volume": pick.choice([9000, 10, -1])}
        found.append(at(pick.randrange(24), pick.randrange(60), event_id=f"e{i}", **changes))
    return [*found, "{bad", "", event(event_timestamp="soon"), event(source=...)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_files_and_a_restart_equal_the_batch_form(spark, tmp_path, mixed, seed):
    order = mixed[:]
    random.Random(seed).shuffle(order)
    for i in range(2):
        deliver(tmp_path, f"f{i}", order[i * 30 : i * 30 + 30])
    run(spark, tmp_path)
    deliver(tmp_path, "f2", order[60:])
    run(spark, tmp_path)
    run(spark, tmp_path)
    found, expected = rates.read_rates(spark, f"{tmp_path}/out"), rates.quarantine_rates(lines_frame(spark, mixed))
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)
    assert sum(row.events for row in found.collect()) == len([line for line in mixed if line != ""])
    untimed = [row for row in found.collect() if row.window_start is None]
    # the malformed line has no source, the line with a wrong time has one
    assert {(row.source, row.events, row.invalid) for row in untimed} == {(None, 1, 1), ("venue_a", 1, 1)}


def test_late_rows_count_and_are_told(spark, tmp_path):
    deliver(tmp_path, "a", [at(10), at(11), at(15, 30)])
    run(spark, tmp_path)
    deliver(tmp_path, "b", [at(14, 45), at(10, 5, volume=-1)])
    run(spark, tmp_path)
    out = f"{tmp_path}/out"
    assert {r.window_start.hour: (r.events, r.invalid) for r in rates.read_rates(spark, out).collect()} == {
        10: (2, 1), 11: (1, 0), 14: (1, 0), 15: (1, 0)
    }
    # the watermark of the second batch is 14:30: the window of 14 is open still, that of 10 is not
    [late] = rates.late_counts(spark, out, 3600).collect()
    assert (late.window_start, late.events, late.invalid) == (datetime(2026, 10, 6, 10), 1, 1)
    assert rates.late_counts(spark, out, 24 * 3600).collect() == []
    assert sorted(r.window_start.hour for r in rates.final_rates(spark, out, 3600).collect()) == [10, 11]


def test_spikes(spark):
    def hour(number, events, invalid, source="a"):
        return (datetime(2026, 1, 1 + number // 24, number % 24), source, events, invalid)

    given = [hour(h, 1000, 10) for h in range(5)]  # one in a hundred
    given += [hour(5, 1000, 29), hour(6, 1000, 39), hour(7, 1000, 60), hour(8, 100, 9)]
    given += [hour(0, 10, 10, "b"), hour(90, 1000, 900)]
    frame = spark.createDataFrame(given, "window_start timestamp_ntz, source string, events long, invalid long")
    found = rates.spikes(frame).collect()
    # 29 < 30; 39 in 1000 is below three times 79 in 6000; 60 is above three times 118 in 7000; 9 are
    # too few; "b" and hour 90 have nothing within a day before them
    assert [(r.source, r.window_start.hour, r.base_events, r.base_invalid) for r in found] == [("a", 7, 7000, 118)]
    assert len(rates.spikes(frame, factor=2).collect()) == 3
    assert rates.spikes(frame.limit(0)).collect() == []


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/New_York"])
def test_windows_do_not_depend_on_the_session(spark, mixed, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    expected = rows(rates.quarantine_rates(lines_frame(spark, mixed)))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert rows(rates.quarantine_rates(lines_frame(spark, mixed))) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
