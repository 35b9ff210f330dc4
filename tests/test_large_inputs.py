"""Events are sorted and dealt out as narrow rows, not as lines."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tapewatch.sources.market_events import dirty_lines, options_lines


@pytest.fixture
def source(spark, tmp_path):
    """An `events` table in no order."""
    rows = [
        (number * 37 % 200, datetime(2026, 3, 1) + timedelta(hours=number), number % 8, "view", number / 4, '{"k": 3}')
        for number in range(200)
    ]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_dirty_lines_are_sorted_before_they_are_written_out(spark, source):
    lines = dirty_lines(spark, source)
    text = physical(lines)
    assert text.index("evt_") < text.index("Sort [") < text.index("Exchange rangepartitioning")
    assert "evt_" not in text[text.index("Sort [") :]
    ids = [row.value.partition('"event_id":"')[2].partition('"')[0] for row in lines.collect() if row.value.strip()]
    numbers = [int(name.removeprefix("evt_")) for name in ids]
    assert len(numbers) == 200 and all(later >= earlier - 1 for earlier, later in zip(numbers, numbers[1:]))


def test_lines_are_dealt_out_before_they_are_written_out(spark, source):
    lines = options_lines(spark, source, parts=3)
    text = physical(lines)
    assert text.index("evt_") < text.index("Exchange hashpartitioning")
    assert "evt_" not in text[text.index("Exchange") :] and "Sort [" not in text
    assert lines.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, lines.collect())) == sorted(map(tuple, options_lines(spark, source).collect()))
