from __future__ import annotations

import os
from datetime import datetime
from glob import glob

import pytest
from helpers import MEDIUM, SMALL, event, events_frame, write_lines
from pyspark.sql import functions as F

from tapewatch.operators.enrich import activity_rows, enrich, process
from tapewatch.operators.first_wins import first_per_key, unique_contracts
from tapewatch.operators.summaries import distinct_symbols
from tapewatch.operators.validate import valid_events
from tapewatch.plans import analytics, warehouse
from tapewatch.plans.commits import FULL_EVERY, CommitLog
from tapewatch.plans.warehouse import Warehouse, load_warehouse
from tapewatch.schema import ENRICHED_FIELDS, RAW_FIELDS, WAREHOUSE_KEYS
from tapewatch.sources.jsonl import parse_events, read_lines
from tapewatch.sources.market_events import options_events, project_events


def enriched(spark, rows):
    return enrich(events_frame(spark, rows))


def test_unique_symbols_and_rows(spark):
    frame = enriched(spark, [event(symbol="ORBT"), event(symbol="KELP"), event(symbol="ORBT")])
    assert [row.symbol for row in distinct_symbols(frame).collect()] == ["KELP", "ORBT"]


def test_flag_rows(spark):
    frame = enriched(spark, [event(volume=9000, open_interest=10), event(event_id="b")])
    rows = activity_rows(frame).collect()
    assert {row.flag for row in rows} == {"HIGH_VOLUME", "VOLUME_EXCEEDS_OPEN_INTEREST"}
    assert {row.event_id for row in rows} == {"evt_a"}


def test_contract_keeps_the_first_attributes(spark):
    rows = [
        event(event_id="b", event_timestamp="2026-10-06T10:21:00", strike=85.0),
        event(event_id="c", event_timestamp="2026-10-06T10:20:00", strike=84.0),
    ]
    assert unique_contracts(enriched(spark, rows)).first().strike == 84.0


def test_input_order_wins_when_recorded(spark, tmp_path):
    rows = [
        event(event_id="b", event_timestamp="2026-10-06T10:21:00", strike=85.0),
        event(event_id="c", event_timestamp="2026-10-06T10:20:00", strike=84.0),
        event(event_id="b", event_timestamp="2026-10-05T10:21:00", strike=86.0),
    ]
    path = write_lines(tmp_path / "in", rows)
    frame = enrich(parse_events(read_lines(spark, path, with_order=True)))
    assert unique_contracts(frame).first().strike == 85.0
    load_warehouse(frame, str(tmp_path / "w"))
    facts = Warehouse(spark, str(tmp_path / "w")).table("fact_options_event")
    assert {row.event_id: float(row.strike) for row in facts.collect()} == {"b": 85.0, "c": 84.0}


def test_hot_key_is_cut_before_the_shuffle(spark):
    frame = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        "id",
    )
    first = first_per_key(frame, ["k"], [F.col("id").desc()])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert first.count() == 20_001
    assert first.filter("k = 'hot'").first().id == 39_998


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    """Two overlapping deliveries of the fixture, loaded, and the second loaded again."""
    root = tmp_path_factory.mktemp("replay")
    raw = project_events(spark.read.parquet(f"{MEDIUM}/events.parquet"))
    valid = valid_events(raw.select(*RAW_FIELDS, "e"))
    first = valid.filter("e % 10 < 7").drop("e")
    second = valid.filter("e % 10 >= 5").drop("e").withColumns(
        {"volume": F.col("volume") + 5000, "strike": F.col("strike") + 1.0}
    )
    counts = []
    for name, part in [("1", first), ("2", second)]:
        enrich(part).write.parquet(f"{root}/in{name}")
    for name, part in [("a", "1"), ("b", "2"), ("c", "2")]:
        batch = spark.read.parquet(f"{root}/in{part}")
        counts.append(load_warehouse(batch, f"{root}/w", reset=name == "a", load_id=name))
    return f"{root}/w", counts


def test_replay_counts(spark, replay):
    _, (first, second, third) = replay
    assert first["fact_options_event"] == 6034
    assert first["fact_options_event"] + second["fact_options_event"] == 8632
    assert (first["fact_unusual_activity"], second["fact_unusual_activity"]) == (3610, 6897)
    assert (first["dim_option_contract"], second["dim_option_contract"]) == (4820, 1481)
    assert first["dim_symbol"] == 8
    assert set(third.values()) == {0}


def test_replay_keeps_first_rows_and_adds_flags(spark, replay):
    root, _ = replay
    store = Warehouse(spark, root)
    events = store.table("fact_options_event").cache()
    assert events.count() == events.select("event_id").distinct().count() == 8632
    flags = store.table("fact_unusual_activity")
    assert flags.count() == flags.select("event_id", "flag").distinct().count() == 3610 + 6897
    late = store.stored("fact_unusual_activity").filter("load_id = 'b'")
    early = store.stored("fact_options_event").filter("load_id = 'a'").select("event_id")
    assert late.join(early, "event_id", "left_semi").count() == 2149


def test_audit_columns(spark, replay):
    root, _ = replay
    store = Warehouse(spark, root)
    symbols = store.stored("dim_symbol")
    assert symbols.filter("symbol_id is null or created_at is null").count() == 0
    ids = store.stored("fact_unusual_activity").agg(F.count_distinct("activity_id")).first()[0]
    assert ids == 3610 + 6897


def test_analytics_run_over_the_tables(spark, replay):
    tables = Warehouse(spark, replay[0]).tables()
    found = analytics.analytics(tables, limit=5)
    assert len(found) == 7
    assert found["Top Unusual Contracts"].count() == 5
    assert found["Unusual Activity Count By Symbol"].count() == 8
    script = analytics.script_analytics(tables)
    assert len(script) == 8
    assert script["highest_ratio"].count() == 25
    total = sum(r.unusual_event_count for r in script["unusual_count_by_symbol"].collect())
    hours = sum(r.unusual_event_count for r in script["unusual_by_hour"].collect())
    assert total == hours


def fact_ids(spark, root):
    return sorted(row.event_id for row in Warehouse(spark, root).table("fact_options_event").collect())


def test_a_load_that_died_leaves_nothing_visible_and_can_run_again(spark, tmp_path, monkeypatch):
    batch = process(options_events(spark, SMALL))
    root = str(tmp_path / "w")
    whole = warehouse.table_delta

    def dies(typed, held, table, buckets):
        if table == "fact_unusual_activity":
            raise RuntimeError("lost")
        return whole(typed, held, table, buckets)

    monkeypatch.setattr(warehouse, "table_delta", dies)
    with pytest.raises(RuntimeError):
        load_warehouse(batch, root, load_id="day1")
    monkeypatch.undo()
    store = Warehouse(spark, root)
    assert glob(f"{root}/fact_options_event/load_id=day1/*/*.parquet")
    assert all(store.table(table).isEmpty() for table in WAREHOUSE_KEYS)
    again = load_warehouse(batch, root, load_id="day1")
    assert again["fact_options_event"] == 863
    assert again["fact_unusual_activity"] == 61 + 120 + 334
    for table, keys in WAREHOUSE_KEYS.items():
        rows = store.table(table)
        assert rows.count() == rows.select(*keys).distinct().count() == again[table]
    # of the two attempts only the one that was committed is kept
    assert store.remove_leftovers() == []
    removed = store.remove_leftovers(older_than_hours=-1)
    assert len(removed) == 3 + 2  # rows of three tables; keys and files of the one fact table among them
    assert store.table("fact_options_event").count() == 863 and store.remove_leftovers(-1) == []


def test_a_committed_load_is_not_run_again(spark, tmp_path):
    root = str(tmp_path / "w")
    first = load_warehouse(enriched(spark, [event()]), root, load_id="day1")
    again = load_warehouse(enriched(spark, [event(), event(event_id="other")]), root, load_id="day1")
    assert first == again and fact_ids(spark, root) == ["evt_a"]
    with pytest.raises(ValueError):
        load_warehouse(enriched(spark, [event()]), root, load_id="a/b")


def interleaved(monkeypatch, action):
    """Runs `action` once, after the first load from now on has written and before it commits."""
    prepared = warehouse._prepared

    def with_action(*args):
        monkeypatch.setattr(warehouse, "_prepared", prepared)
        mine = prepared(*args)
        action()
        return mine

    monkeypatch.setattr(warehouse, "_prepared", with_action)


def test_two_loads_at_once_insert_each_key_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "w")
    one = [event(event_id="a", strike=1.0), event(event_id="b", strike=1.0, volume=9000)]
    two = [event(event_id="b", strike=2.0, implied_volatility=0.9), event(event_id="c", strike=2.0)]
    second = {}
    interleaved(
        monkeypatch, lambda: second.update(load_warehouse(enriched(spark, two), root, load_id="two"))
    )
    first = load_warehouse(enriched(spark, one), root, load_id="one")
    store = Warehouse(spark, root)
    facts = {row.event_id: (float(row.strike), row.load_id) for row in store.stored("fact_options_event").collect()}
    assert facts == {"a": (1.0, "one"), "b": (2.0, "two"), "c": (2.0, "two")}
    # the one contract and the symbol came with the load that was committed first
    assert [float(row.strike) for row in store.table("dim_option_contract").collect()] == [2.0]
    assert store.table("dim_symbol").count() == 1
    flags = {(row.event_id, row.flag) for row in store.table("fact_unusual_activity").collect()}
    assert flags == {("b", "HIGH_VOLUME"), ("b", "HIGH_IV")}
    assert first == {"dim_symbol": 0, "dim_option_contract": 0, "fact_options_event": 1, "fact_unusual_activity": 1}
    assert second == {"dim_symbol": 1, "dim_option_contract": 1, "fact_options_event": 2, "fact_unusual_activity": 1}
    third = load_warehouse(enriched(spark, one + two), root)
    assert set(third.values()) == {0}


def test_loads_without_a_common_key_and_the_same_load_twice(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "w")
    load_warehouse(enriched(spark, [event()]), root)
    other = enriched(spark, [event(event_id="z", contract_symbol="Z", symbol="ZZ")])
    interleaved(monkeypatch, lambda: load_warehouse(other, root))
    mine = load_warehouse(enriched(spark, [event(event_id="y", contract_symbol="Y", symbol="YY")]), root)
    assert mine["fact_options_event"] == mine["dim_symbol"] == 1
    twin = enriched(spark, [event(event_id="twin")])
    interleaved(monkeypatch, lambda: load_warehouse(twin, root, load_id="twin"))
    assert load_warehouse(twin, root, load_id="twin")["fact_options_event"] == 1
    assert fact_ids(spark, root) == ["evt_a", "twin", "y", "z"]


def test_a_reset_between_writing_and_committing(spark, tmp_path, monkeypatch):
    """What a load left out because the old tables held it is inserted into the new ones."""
    root = str(tmp_path / "w")
    load_warehouse(enriched(spark, [event(event_id="a")]), root)
    fresh = enriched(spark, [event(event_id="new")])
    interleaved(monkeypatch, lambda: load_warehouse(fresh, root, reset=True))
    load_warehouse(enriched(spark, [event(event_id="a"), event(event_id="b")]), root)
    assert fact_ids(spark, root) == ["a", "b", "new"]


def test_one_writer_takes_a_version_and_readers_open_few_files(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "w"))
    start = log.state()
    assert (start.version, start.loads) == (-1, {})
    assert log.append(start, buckets=4) and not log.append(start, buckets=8)
    state = log.state()
    assert (state.version, state.buckets) == (0, 4)
    for number in range(70):
        load = {"load_id": f"l{number}", "attempts": {"t": f"a{number}"}, "rows": {"t": number}}
        assert log.append(log.state(), load=load)
    opened = []
    read = log._read
    log._read = lambda version: opened.append(version) or read(version)
    state = log.state()
    assert len(state.loads) == 70 and state.loads["l69"].rows == {"t": 69} and state.buckets == 4
    assert len(opened) <= FULL_EVERY
    assert not [name for name in os.listdir(tmp_path / "w" / "_commits") if name.startswith(".") and not name.endswith(".crc")]


def test_an_hour_of_a_year_opens_few_files(spark, tmp_path):
    root = str(tmp_path / "w")
    minutes = spark.range(0, 365 * 24 * 60, 20)
    at = F.expr("timestamp_ntz '2026-01-01 00:00:00' + make_dt_interval(0, 0, id, 0)")
    events = (
        enriched(spark, [event(volume=9000)])
        .drop("event_id", "event_timestamp")
        .crossJoin(minutes)
        .select("*", F.concat(F.lit("e"), "id").alias("event_id"), at.alias("event_timestamp"))
    )
    events.select(*ENRICHED_FIELDS).orderBy(F.rand(1)).write.parquet(f"{root}/in")
    settings = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        load_warehouse(spark.read.parquet(f"{root}/in"), f"{root}/w", key_buckets=2)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    store = Warehouse(spark, f"{root}/w")
    start, end = datetime(2026, 7, 1, 13), datetime(2026, 7, 1, 14)
    for table in warehouse.TIMED:
        everything = len(glob(f"{store.path(table)}/*/*/*.parquet"))
        opened = store.files_between(table, start, end)
        assert everything >= 150 and 1 <= len(opened) <= everything / 100 + 1
        rows = store.between(table, start, end)
        assert rows.count() == 3
        whole = store.table(table).filter(F.col("event_timestamp").between(start, datetime(2026, 7, 1, 13, 59)))
        assert rows.exceptAll(whole).isEmpty() and whole.exceptAll(rows).isEmpty()
        assert store.files_between(table, datetime(2020, 1, 1), datetime(2020, 1, 2)) == []
        assert store.between(table, datetime(2020, 1, 1), datetime(2020, 1, 2)).isEmpty()
    assert Warehouse(spark, str(tmp_path / "none")).between("fact_options_event", start, end).isEmpty()


def test_reset_empties_the_tables(spark, tmp_path):
    root = str(tmp_path / "w")
    load_warehouse(enriched(spark, [event()]), root)
    load_warehouse(enriched(spark, [event(event_id="z")]), root, reset=True)
    rows = Warehouse(spark, root).table("fact_options_event").collect()
    assert [row.event_id for row in rows] == ["z"]


def test_rows_that_do_not_fit_are_set_aside(spark, tmp_path):
    rows = [
        event(),
        event(event_id="big", strike=1e11, contract_symbol="BIG"),
        event(event_id="nodelta", delta=None),
        event(event_id="ratio", volume=2_000_000_000, open_interest=1),
        event(event_id=None, volume=9000),
    ]
    root = str(tmp_path / "w")
    counts = load_warehouse(enriched(spark, rows), root)
    assert counts == {
        "dim_symbol": 1,
        "dim_option_contract": 1,
        "fact_options_event": 1,
        "fact_unusual_activity": 2,
    }
    rejects = Warehouse(spark, root).stored("load_rejects").collect()
    assert {row.event_id: row.reasons for row in rejects} == {
        "big": ["strike does not fit fact_options_event"],
        "nodelta": ["delta does not fit fact_options_event"],
        "ratio": ["volume_open_interest_ratio does not fit fact_options_event"],
        None: ["event_id does not fit fact_options_event"],
    }


def test_stored_types(spark, tmp_path):
    row = event(event_timestamp="2026-05-29T13:45:00+05:30", strike=530.125, bid=4.20005)
    root = str(tmp_path / "w")
    load_warehouse(enriched(spark, [row]), root)
    stored = Warehouse(spark, root).table("fact_options_event").first()
    assert stored.event_timestamp == datetime(2026, 5, 29, 8, 15)
    assert str(stored.strike) == "530.13"
    assert str(stored.bid) == "4.2001"
