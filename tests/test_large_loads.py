"""Loads of large batches: the rows of small ones, moved once and sorted in tasks of one size."""

from __future__ import annotations

from contextlib import ExitStack

import pytest
from helpers import event, events_frame

from tapewatch.operators.enrich import process
from tapewatch.plans import warehouse
from tapewatch.schema import ENRICHED_FIELDS


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def enriched(spark, rows):
    return process(events_frame(spark, rows)).select(*ENRICHED_FIELDS)


def batches(spark):
    """Two loads: ids within a batch repeat, some alike in all, and the second repeats ids of the first."""
    at = "2026-10-{:02d}T10:20:00".format
    first = [event(event_id=f"e{n % 20}", event_timestamp=at(n % 9 + 1), volume=9000 + n) for n in range(60)]
    second = [event(event_id=f"e{n % 30}", event_timestamp=at(n % 7 + 1), volume=7000 + n) for n in range(60)]
    return enriched(spark, first + first[:5]), enriched(spark, second + second[-5:])


def contents(root, spark):
    home = warehouse.Warehouse(spark, root)
    return {
        table: sorted(map(str, home.stored(table).select(*warehouse.WAREHOUSE_COLUMNS[table].names, "load_id").collect()))
        for table in warehouse.TABLES
    }


def load_all(spark, root, raced):
    first, second = batches(spark)
    if raced:
        slow = warehouse.prepare_load(first, root, "one")
        counts = [warehouse.load_warehouse(second, root, load_id="two"), warehouse.commit_load(slow)]
    else:
        counts = [warehouse.load_warehouse(rows, root, load_id=name) for rows, name in ((first, "one"), (second, "two"))]
    return counts, contents(root, spark)


@pytest.mark.parametrize("raced", [False, True])
def test_large_batches_load_the_rows_that_small_ones_do(spark, tmp_path, monkeypatch, raced):
    small = load_all(spark, f"{tmp_path}/small", raced)
    used = []
    large = warehouse.large_delta
    monkeypatch.setattr(warehouse, "TASK_ROWS", 8)
    monkeypatch.setattr(warehouse, "KEY_BUCKETS", 2)
    monkeypatch.setattr(warehouse, "large_delta", lambda *args: used.append(args[2]) or large(*args))
    assert load_all(spark, f"{tmp_path}/large", raced) == small
    assert used == warehouse.TIMED * 2
    # buckets by the rows of the first load
    assert warehouse.Warehouse(spark, f"{tmp_path}/large").log.state().buckets == 9


@pytest.mark.parametrize("table", warehouse.TIMED)
def test_rows_of_a_large_batch_move_once_and_unsorted(spark, tmp_path, table):
    first, second = batches(spark)
    warehouse.load_warehouse(first, f"{tmp_path}/w", key_buckets=3)
    second.write.parquet(f"{tmp_path}/second")
    typed = warehouse.with_types(spark.read.parquet(f"{tmp_path}/second"))
    home = warehouse.Warehouse(spark, f"{tmp_path}/w")
    state = home.log.state()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with ExitStack() as stack:
            held = warehouse._held(stack, home, table, state.loads.values(), state.buckets)
            text = physical(warehouse.large_delta(typed, held, table, state.buckets))
            fresh = physical(warehouse.large_delta(typed, None, table, 5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 1 and fresh.count("Exchange") == 1
    assert "Bucketed: true" in text and "Sort [" not in fresh[fresh.index("Exchange") :]
