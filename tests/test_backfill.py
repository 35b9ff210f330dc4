"""Corrections of past days: what they touch, what they leave, and runs that die."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pytest

from tapewatch.plans import backfill, history

LAYOUT = "event_id string, contract_symbol string, volume int, event_date date"
START = date(2026, 4, 1)


def day(number):
    return START + timedelta(days=number)


@pytest.fixture
def layer(spark, tmp_path):
    rows = [(f"e{i}", f"c{i % 3}", i, day(i % 10)) for i in range(100)] + [("only", "c9", 1, day(20))]
    frame = spark.createDataFrame(rows, LAYOUT)
    backfill.write_days(frame, f"{tmp_path}/days")
    history.update_history(frame, f"{tmp_path}/history")
    return tmp_path


def files(folder):
    return {str(f): f.read_bytes() for f in Path(folder).glob("event_date=*/*.parquet")}


def stored(spark, root):
    rows = backfill.read_days(spark, f"{root}/days").select("event_id", "volume", "event_date").collect()
    return sorted(map(tuple, rows))


def run(spark, root, given, name="r", gone=None):
    withdrawn = spark.createDataFrame([(g,) for g in gone], "event_id string") if gone else None
    frame = spark.createDataFrame(given, LAYOUT)
    return backfill.backfill(frame, f"{root}/days", name, withdrawn, f"{root}/history")


GIVEN = [("e4", "c1", 999, day(4)), ("e5", "c2", 5, day(7)), ("new", "c1", 8, day(12)), (None, "c", 1, day(1)), ("x", "c", 1, None)]


def expected(before):
    rows = [row for row in before if row[0] not in ("e4", "e5", "only", "e18")]
    return sorted([*rows, ("e4", 999, day(4)), ("e5", 5, day(7)), ("new", 8, day(12))])


def test_only_touched_days_are_written(spark, layer):
    before, first = stored(spark, layer), {**files(layer / "days"), **files(layer / "history")}
    touched = run(spark, layer, GIVEN, gone=["only", "e18", "unknown", "e4"])
    assert touched == [day(4), day(5), day(7), day(8), day(12), day(20)]
    assert stored(spark, layer) == expected(before)
    now = {**files(layer / "days"), **files(layer / "history")}
    untouched = {name for name in first if not any(f"event_date={d}" in name for d in touched)}
    assert len(untouched) >= 10 and all(now[name] == first[name] for name in untouched)
    assert not (layer / "days" / f"event_date={day(20)}").exists()
    # the history is that of the corrected layer
    history.update_history(backfill.read_days(spark, f"{layer}/days"), f"{layer}/again")
    found, wanted = (sorted(map(tuple, history.read_history(spark, f"{layer}/{name}").collect())) for name in ("history", "again"))
    assert found == wanted


def test_a_second_run_changes_nothing(spark, layer):
    run(spark, layer, GIVEN, gone=["only", "e18"])
    after = stored(spark, layer)
    assert run(spark, layer, GIVEN, gone=["only", "e18"])
    assert stored(spark, layer) == after
    run(spark, layer, GIVEN, name="other", gone=["only", "e18"])
    assert stored(spark, layer) == after


@pytest.mark.parametrize("fails", ["write_days", "_without_empty_days", "update_history"])
def test_a_run_that_died_is_run_again(spark, layer, monkeypatch, fails):
    before = stored(spark, layer)

    def broken(*_):
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(backfill, fails, broken)
        with pytest.raises(RuntimeError):
            run(spark, layer, GIVEN, gone=["only", "e18"])
    run(spark, layer, GIVEN, gone=["only", "e18"])
    assert stored(spark, layer) == expected(before)
    of_day = history.read_history(spark, f"{layer}/history", first=day(4), last=day(4)).collect()
    assert sum(row.total for row in of_day) == sum(v for _, v, d in expected(before) if d == day(4))


def test_nothing_to_correct(spark, layer):
    before = files(layer / "days")
    assert run(spark, layer, []) == []
    assert files(layer / "days") == before
