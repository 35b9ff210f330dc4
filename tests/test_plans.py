"""Plan shapes that decide whether the jobs hold at scale."""

from __future__ import annotations

import re
from contextlib import ExitStack

import pytest
from helpers import SMALL, write_lines

from tapewatch.operators import rankings, summaries
from tapewatch.operators.enrich import activity_rows, process, unusual_events
from tapewatch.operators.validate import valid_events
from tapewatch.plans import analytics, batch, marts, reports, warehouse
from tapewatch.plans.batch import classify
from tapewatch.sources.jsonl import read_events
from tapewatch.sources.market_events import options_events, options_lines
from tapewatch.streaming import consumer


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def read_columns(text: str) -> set[str]:
    [schema] = re.findall(r"ReadSchema: struct<(.*)>", text)
    return {part.split(":")[0] for part in re.sub(r"\(.*?\)|<.*?>", "", schema).split(",")}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    options_lines(spark, SMALL).write.text(f"{root}/in")
    options_events(spark, SMALL).write.parquet(f"{root}/columnar")
    batch.run_batch(spark, f"{root}/in", f"{root}/out")
    warehouse.load_warehouse(batch.read_valid(spark, f"{root}/out"), f"{root}/w")
    return root


@pytest.fixture(scope="module")
def facts(spark, store):
    return warehouse.Warehouse(spark, f"{store}/w").table("fact_options_event")


def test_filters_and_columns_reach_the_scan(facts):
    text = plan(summaries.unusual_count_by_symbol(facts))
    assert read_columns(text) == {"symbol", "unusual_activity_score"}
    assert "GreaterThan(unusual_activity_score,0)" in text
    text = plan(rankings.highest_ratio(facts))
    assert "IsNotNull(volume_open_interest_ratio)" in text
    assert read_columns(plan(summaries.average_iv_by_symbol(facts))) == {
        "symbol",
        "implied_volatility",
    }


def test_validation_of_columnar_input_is_pushed_down(spark, store):
    text = plan(valid_events(spark.read.parquet(f"{store}/columnar")))
    for pushed in ("GreaterThanOrEqual(volume,0)", "GreaterThan(strike,0.0)", "In(option_type"):
        assert pushed in text


def test_routes_are_pruned(spark, store):
    text = plan(summaries.flag_distribution(batch.read_valid(spark, f"{store}/out")))
    assert "PartitionFilters: [isnotnull(route" in text
    assert read_columns(text) == {"unusual_activity_flags"}


def test_flags_are_filtered_before_explode(spark, store):
    text = plan(activity_rows(batch.read_valid(spark, f"{store}/out")))
    generate = text.index("Generate")
    assert "size(unusual_activity_flags" in text[generate:]


def test_top_n_never_sorts_everything(facts, spark, store):
    enriched = batch.read_valid(spark, f"{store}/out")
    for ranked in (
        rankings.top_unusual_contracts(facts),
        rankings.highest_ratio_script(facts),
        rankings.top_unusual_contracts_report(enriched),
        rankings.top_symbols_by_volume(facts),
    ):
        text = plan(ranked)
        assert "TakeOrderedAndProject" in text
        assert "rangepartitioning" not in text


def test_summaries_combine_before_the_shuffle(facts):
    for summary in (
        summaries.symbol_summary(facts),
        summaries.option_type_summary(facts),
        summaries.unusual_by_hour(facts),
    ):
        text = plan(summary)
        assert text.index("partial_count") < text.index("hashpartitioning")
        assert text.count("hashpartitioning") == 1


def test_validation_and_routing_do_not_shuffle(spark, store):
    events = read_events(spark, f"{store}/in")
    for frame in (process(events), classify(events), consumer.output_lines(consumer.route(events))):
        text = plan(frame)
        assert "Exchange" not in text
        assert text.count("from_json") == 1


def test_no_python_and_no_cross_join_anywhere(spark, store, facts):
    enriched = batch.read_valid(spark, f"{store}/out")
    tables = warehouse.Warehouse(spark, f"{store}/w").tables()
    frames = [
        *reports.reports(enriched).values(),
        *marts.marts(enriched).values(),
        *analytics.analytics(tables).values(),
        *analytics.script_analytics(tables).values(),
    ]
    for frame in frames:
        text = plan(frame)
        for word in ("Python", "Cartesian", "NestedLoop", "ObjectHashAggregate", "SortAggregate"):
            assert word not in text


def above(text: str, node: str) -> list[str]:
    """Names of the operators above the first line of a plan tree that holds `node`."""
    lines = [line for line in text.splitlines() if line.strip()]
    at = next(i for i, line in enumerate(lines) if node in line)
    depth, found = re.search(r"\w", lines[at]).start(), []
    for line in reversed(lines[:at]):
        start = re.search(r"\w", line).start()
        if start < depth:
            depth = start
            found.append(line.strip(" :+-*"))
    return found


def delta_tree(spark, store, table):
    """Physical plan of a second load, its keys found by a join of both sides, none broadcast."""
    home = warehouse.Warehouse(spark, f"{store}/w")
    typed = warehouse.with_types(batch.read_valid(spark, f"{store}/out"))
    state = home.log.state()
    with ExitStack() as stack:
        held = warehouse._held(stack, home, table, state.loads.values(), state.buckets)
        delta = warehouse.table_delta(typed, held, table, state.buckets)
        return delta._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("table", warehouse.TABLES)
def test_the_history_is_never_moved(spark, store, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = delta_tree(spark, store, table)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    held = next(line for line in text.splitlines() if "bucketed_" in line)
    assert "Bucketed: true" in held
    assert not [name for name in above(text, "bucketed_") if "Exchange" in name]
    # of the history only keys are read, and no row of a fact table
    keys = set(warehouse.WAREHOUSE_KEYS[table])
    assert set(re.search(r"ReadSchema: struct<(.*?)>", held)[1].replace(":string", "").split(",")) == keys
    assert "load_id=" not in text or table not in warehouse.TIMED
    # the partial limit per key sits below the shuffle, the final one above
    if table != "dim_symbol":
        assert text.index("WindowGroupLimit") < text.rindex("WindowGroupLimit")


def test_a_small_batch_is_broadcast(spark, store):
    text = delta_tree(spark, store, "fact_options_event")
    assert "BroadcastHashJoin" in text and "LeftSemi, BuildRight" in text


def test_generated_code_stays_compilable(spark, store):
    """The JVM does not compile methods above 8000 bytes; such a stage runs many times slower."""
    events = read_events(spark, f"{store}/in")
    enriched = batch.read_valid(spark, f"{store}/out")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frames = [
            process(events),
            classify(events),
            consumer.output_lines(consumer.route(events), log=True),
            *reports.reports(enriched).values(),
            *marts.marts(enriched).values(),
        ]
        for frame in frames:
            text = frame.select("*")._jdf.queryExecution().explainString(mode)
            sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_batch_write_does_not_sort(spark, tmp_path, store):
    """Rows of both routes leave a task as they come."""
    with batch.unsorted_partition_writes(spark):
        assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 2
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    write_lines(tmp_path / "in", ["{}"] * 3)
    counts = batch.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert (counts.read, counts.invalid) == (3, 3)
    assert unusual_events(batch.read_valid(spark, str(tmp_path / "out"))).count() == 0
