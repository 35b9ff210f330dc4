"""Every registered query. Each reads whole tables of `sf_dir`.

The order of a real deployment: events as JSON-lines files; validation and routing on those;
reports and marts on the Parquet layer a batch run wrote from them; analytics on the tables a
load wrote from that. Each layer is written once per session and input, in the shared folder.
Results carry doubles for decimals and ISO text for dates, so that engines compare alike.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.scratch import new_folder
from tapewatch.functions.text import event_summary, piped_flags, processing_summary
from tapewatch.operators import baseline, drift, rankings, summaries
from tapewatch.operators.enrich import activity_rows, enrich, process, unusual_events, with_types
from tapewatch.operators.first_wins import unique_contracts
from tapewatch.operators.validate import (
    ERRORS,
    MALFORMED,
    invalid_events,
    is_valid,
    split_events,
    with_validation_errors,
)
from tapewatch.plans import backfill, batch, history, marts, metrics, outputs, reports, warehouse
from tapewatch.schema import DERIVED_FIELDS, ENRICHED_FIELDS, RAW_FIELDS
from tapewatch.sources.jsonl import json_lines, parse_events, read_enriched, read_events, read_lines, write_jsonl
from tapewatch.sources.market_events import dirty_lines, options_events, options_lines, project_events, source_events
from tapewatch.sources.tables import read_csv, write_csv, write_parquet
from tapewatch.streaming import alerts, compaction, consumer, rates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query, name: str | None = None) -> Query:
    QUERIES[name or build.__name__] = build
    return build


def named(name: str) -> Callable[[Query], Query]:
    """Register under a name that an operator of this module already has."""
    return lambda build: query(build, name)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates as ISO text, flag arrays as piped text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, "|")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# ---- inputs -------------------------------------------------------------------------


_written: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, build: Callable[[str], object]) -> object:
    """Run `build(folder)` the first time a session asks for it; returns its result."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        _written[key] = build(new_folder(spark, label))
    return _written[key]


def raw_folder(spark: SparkSession, sf_dir: str) -> str:
    """All events as JSON-lines files."""

    def build(folder: str) -> str:
        options_lines(spark, sf_dir).write.option("maxRecordsPerFile", 1_000_000).text(folder)
        return folder

    return _once(spark, sf_dir, "raw", build)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, raw_folder(spark, sf_dir))


def batch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched Parquet layer that a batch run writes from JSON lines."""

    def build(folder: str) -> DataFrame:
        batch.run_batch(spark, raw_folder(spark, sf_dir), folder)
        return batch.read_valid(spark, folder)

    return _once(spark, sf_dir, "batch", build)


def loaded_warehouse(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    """The four tables, loaded from the batch layer."""

    def build(folder: str) -> warehouse.Warehouse:
        warehouse.load_warehouse(batch_events(spark, sf_dir), folder, reset=True)
        return warehouse.Warehouse(spark, folder)

    return _once(spark, sf_dir, "warehouse", build)


def _loaded_in_input_order(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    """Tables loaded from lines that come latest event first and disagree about a contract's strike."""

    def build(folder: str) -> warehouse.Warehouse:
        latest_first = project_events(source_events(spark, sf_dir).orderBy(F.desc("event_id")))
        strike = F.when(F.col("strike") > 0, F.col("strike") + F.col("e") % 7).otherwise(F.col("strike"))
        json_lines(latest_first.withColumn("strike", strike).select(*RAW_FIELDS), keep_nulls=False).write.text(f"{folder}/raw")
        batch.run_batch(spark, f"{folder}/raw", f"{folder}/layer")
        events = batch.read_valid(spark, f"{folder}/layer", with_order=True)
        warehouse.load_warehouse(events, f"{folder}/tables")
        return warehouse.Warehouse(spark, f"{folder}/tables")

    return _once(spark, sf_dir, "input-order", build)


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_warehouse(spark, sf_dir).table("fact_options_event")


def replayed_events(first: DataFrame) -> DataFrame:
    """A second delivery of every event with a changed payload.

    Events of even volume come as new events on an adjusted contract, the others under the
    id and contract they had.
    """
    fresh = F.col("volume") % 2 == 0
    changed = first.select(
        F.when(fresh, F.concat("event_id", F.lit("_b"))).otherwise(F.col("event_id")).alias(
            "event_id"
        ),
        F.when(fresh, F.concat("contract_symbol", F.lit("_ADJ")))
        .otherwise(F.col("contract_symbol"))
        .alias("contract_symbol"),
        (F.col("volume") + 5000).alias("volume"),
        (F.col("strike") + 1.0).alias("strike"),
        *[
            name
            for name in first.columns
            if name not in ("event_id", "contract_symbol", "volume", "strike")
        ],
    )
    return enrich(changed)


Loads = tuple[warehouse.Warehouse, list[tuple[str, str, int]]]


def _replayed_warehouse(spark: SparkSession, sf_dir: str) -> Loads:
    """Three loads: every event, its changed replay, and that replay again."""

    def build(folder: str) -> Loads:
        first = batch_events(spark, sf_dir)
        second = replayed_events(first.drop(*DERIVED_FIELDS))
        counts = []
        for load, events in [("load1", first), ("load2", second), ("load3", second)]:
            inserted = warehouse.load_warehouse(
                events, folder, reset=load == "load1", load_id=load
            )
            counts += [(load, table, rows) for table, rows in inserted.items()]
        return warehouse.Warehouse(spark, folder), counts

    return _once(spark, sf_dir, "replay", build)


# ---- validation and enrichment ------------------------------------------------------


@query
def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = with_validation_errors(_parsed(spark, sf_dir))
    return checked.select("event_id", F.array_join(ERRORS, ";").alias(ERRORS))


@query
def validation_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = invalid_events(_parsed(spark, sf_dir)).select(F.explode(ERRORS).alias("error"))
    return errors.groupBy("error").agg(F.count(F.lit(1)).alias("events")).orderBy("error")


@query
def validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    return parsed.select("event_id", is_valid(parsed).alias("is_valid"))


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, invalid = split_events(_parsed(spark, sf_dir))
    return invalid.select("event_id", F.array_join(ERRORS, ";").alias(ERRORS))


@query
def columnar_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, invalid = split_events(options_events(spark, sf_dir))
    return invalid.select("event_id", F.array_join(ERRORS, ";").alias(ERRORS))


@named("enrich")
def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(process(_parsed(spark, sf_dir)).select(*ENRICHED_FIELDS))


@query
def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = with_types(batch_events(spark, sf_dir))
    return plain(
        typed.select(
            "event_id",
            "event_timestamp",
            "expiration_date",
            "event_date",
            "event_hour",
            "volume",
            "open_interest",
            "implied_volatility",
            "unusual_activity_score",
            "volume_open_interest_ratio",
            "underlying_price",
            "strike",
        )
    )


@query
def event_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = consumer.route(_parsed(spark, sf_dir))
    return routed.select(
        "event_id",
        event_summary().alias("event_line"),
        processing_summary(
            F.col("is_valid"),
            F.coalesce("unusual_activity_score", F.lit(0)),
            F.coalesce("unusual_activity_flags", F.array().cast("array<string>")),
        ).alias("status_line"),
    )


@query
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.run_metrics(_parsed(spark, sf_dir))


# ---- input as careless senders write it ---------------------------------------------


def dirty_layer(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a batch run over dirty lines."""

    def build(folder: str) -> str:
        dirty_lines(spark, sf_dir).write.text(f"{folder}/raw")
        batch.run_batch(spark, f"{folder}/raw", f"{folder}/layer")
        return f"{folder}/layer"

    return _once(spark, sf_dir, "dirty", build)


def _dirty_warehouse(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    """Tables loaded from the dirty lines, of repeated ids the first in the input."""

    def build(folder: str) -> warehouse.Warehouse:
        events = batch.read_valid(spark, dirty_layer(spark, sf_dir), with_order=True)
        warehouse.load_warehouse(events, folder)
        return warehouse.Warehouse(spark, folder)

    return _once(spark, sf_dir, "dirty-tables", build)


@query
def dirty_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = batch.read_invalid(spark, dirty_layer(spark, sf_dir))
    return found.groupBy(F.array_join(ERRORS, ";").alias(ERRORS)).agg(F.count(F.lit(1)).alias("lines"))


@query
def dirty_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined lines that are JSON objects, by the id that they carry."""
    found = batch.read_invalid(spark, dirty_layer(spark, sf_dir)).filter(~F.array_contains(ERRORS, MALFORMED))
    event_id = F.get_json_object("value", "$.event_id").alias("event_id")
    return found.select(event_id, F.array_join(ERRORS, ";").alias(ERRORS))


@query
def dirty_typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = with_types(batch.read_valid(spark, dirty_layer(spark, sf_dir)))
    return plain(typed.select("event_id", "event_timestamp", "event_date", "event_hour", "volume", "strike", "source"))


@query
def dirty_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _dirty_warehouse(spark, sf_dir).table("fact_options_event")
    return plain(facts.select("event_id", "contract_symbol", "volume", "strike", "event_timestamp", "source"))


@query
def dirty_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = _dirty_warehouse(spark, sf_dir).stored(warehouse.REJECTS)
    return rejects.select("event_id", F.array_join("reasons", ";").alias("reasons"))


# ---- reports and marts --------------------------------------------------------------


@query
def symbol_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: one lazy plan from the table through JSON text to the summary."""
    events = parse_events(options_lines(spark, sf_dir))
    return summaries.symbol_summary(process(events))


@query
def flag_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.flag_distribution(batch_events(spark, sf_dir))


@query
def option_type_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.option_type_summary(batch_events(spark, sf_dir))


@query
def top_unusual_contracts_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rankings.top_unusual_contracts_report(batch_events(spark, sf_dir))


@named("unusual_events")
def unusual_events_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = with_types(batch_events(spark, sf_dir))
    return plain(unusual_events(typed))


@query
def symbol_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(summaries.symbol_daily_summary(with_types(batch_events(spark, sf_dir))))


@query
def csv_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol report written as CSV and read back."""
    folder = new_folder(spark, "csv")
    columns = reports.REPORT_COLUMNS["symbol_summary"]
    write_csv(summaries.symbol_summary(batch_events(spark, sf_dir)), folder, columns)
    schema = (
        "symbol string, total_events bigint, unusual_events bigint, unusual_event_pct double, "
        "total_volume bigint, avg_implied_volatility double, avg_unusual_activity_score double"
    )
    return read_csv(spark, folder, schema)


@query
def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written per report file."""
    enriched = batch_events(spark, sf_dir)
    written = reports.write_reports(enriched, new_folder(spark, "reports"))
    return spark.createDataFrame(sorted(written.items()), "report string, rows bigint")


@query
def mart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written per mart, the events mart partitioned by day."""
    enriched = batch_events(spark, sf_dir)
    folder = new_folder(spark, "marts")
    written = marts.write_marts(enriched, folder, partition_events_by=["event_date"])
    return spark.createDataFrame(sorted(written.items()), "mart string, rows bigint")


_MEASURES = (
    "total_events bigint, unusual_events bigint, unusual_event_pct double, total_volume bigint, "
    "avg_implied_volatility double, avg_unusual_activity_score double"
)
_REPORT_LAYOUTS = {
    "top_unusual_contracts": (
        "contract_symbol string, symbol string, option_type string, strike double, "
        "expiration_date string, volume int, open_interest int, volume_open_interest_ratio double, "
        "implied_volatility double, unusual_activity_score int, unusual_activity_flags string"
    ),
    "symbol_summary": f"symbol string, {_MEASURES}",
    "flag_distribution": "flag string, `count` bigint",
    "option_type_summary": f"option_type string, {_MEASURES}",
}
_MARTS = ["unusual_events", "symbol_daily_summary", "flag_summary", "option_type_summary"]


def _written_outputs(spark: SparkSession, sf_dir: str) -> str:
    """Every report and mart, written from the batch layer in two scans."""

    def build(folder: str) -> str:
        outputs.write_outputs(
            batch_events(spark, sf_dir),
            f"{folder}/reports",
            f"{folder}/marts",
            partition_events_by=["event_date"],
        )
        return folder

    return _once(spark, sf_dir, "outputs", build)


def _report_file(name: str) -> Query:
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _written_outputs(spark, sf_dir)
        return read_csv(spark, f"{folder}/reports/{name}", _REPORT_LAYOUTS[name])

    return read


def _mart_file(name: str) -> Query:
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(spark.read.parquet(f"{_written_outputs(spark, sf_dir)}/marts/{name}"))

    return read


for _name in _REPORT_LAYOUTS:
    query(_report_file(_name), f"report_file_{_name}")
for _name in _MARTS:
    query(_mart_file(_name), f"mart_file_{_name}")


@query
def batch_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events of a whole batch run: text in, one pass, Parquet out."""
    return plain(batch_events(spark, sf_dir))


@query
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "jsonl")
    write_jsonl(batch_events(spark, sf_dir).select(*ENRICHED_FIELDS), folder)
    return plain(read_enriched(spark, folder))


@query
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "parquet")
    write_parquet(batch_events(spark, sf_dir).select(*ENRICHED_FIELDS), folder)
    return plain(spark.read.parquet(folder))


# ---- warehouse ----------------------------------------------------------------------


@query
def distinct_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.distinct_symbols(batch_events(spark, sf_dir))


@named("unique_contracts")
def unique_contract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(unique_contracts(batch_events(spark, sf_dir)))


@query
def unusual_activity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_rows(batch_events(spark, sf_dir))


@query
def dim_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_warehouse(spark, sf_dir).table("dim_symbol")


@query
def dim_option_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(loaded_warehouse(spark, sf_dir).table("dim_option_contract"))


@query
def fact_options_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_facts(spark, sf_dir))


@query
def fact_unusual_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_warehouse(spark, sf_dir).table("fact_unusual_activity")


@query
def contracts_in_input_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts as the input first names them, which here is last by time."""
    return plain(_loaded_in_input_order(spark, sf_dir).table("dim_option_contract"))


@query
def warehouse_merge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _replayed_warehouse(spark, sf_dir)[0].table("fact_options_event")
    return plain(
        facts.select("event_id", "contract_symbol", "volume", "strike", "unusual_activity_score")
    )


@query
def warehouse_merge_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_replayed_warehouse(spark, sf_dir)[0].table("dim_option_contract"))


@query
def warehouse_merge_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replayed_warehouse(spark, sf_dir)[0].table("fact_unusual_activity")


@query
def warehouse_insert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _replayed_warehouse(spark, sf_dir)[1]
    return spark.createDataFrame(counts, "load string, table_name string, rows_inserted bigint")


#: One day of the test data's thirty, read by time.
DAY = (datetime(2024, 1, 10), datetime(2024, 1, 11))


@query
def events_of_a_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of one day, from the files that hold some of it."""
    return plain(loaded_warehouse(spark, sf_dir).between("fact_options_event", *DAY))


@query
def flags_of_a_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_warehouse(spark, sf_dir).between("fact_unusual_activity", *DAY)


def _raced_warehouse(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    """Two loads that begin on the same empty tables; the changed replay is committed first."""

    def build(folder: str) -> warehouse.Warehouse:
        first = batch_events(spark, sf_dir)
        home = warehouse.Warehouse(spark, folder)
        home.create(key_buckets=warehouse.parts_of(first.count()))
        slow = warehouse.prepare_load(first, folder, "slow")
        warehouse.load_warehouse(replayed_events(first.drop(*DERIVED_FIELDS)), folder, load_id="quick")
        warehouse.commit_load(slow)
        return home

    return _once(spark, sf_dir, "raced", build)


@query
def concurrent_load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _raced_warehouse(spark, sf_dir).stored("fact_options_event")
    return plain(facts.select("event_id", "contract_symbol", "volume", "strike", "load_id"))


@query
def concurrent_load_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_raced_warehouse(spark, sf_dir).table("dim_option_contract"))


@query
def concurrent_load_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raced_warehouse(spark, sf_dir).table("fact_unusual_activity")


# ---- analytics ----------------------------------------------------------------------


@query
def symbol_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.symbol_summary(_facts(spark, sf_dir))


@query
def unusual_count_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.unusual_count_by_symbol(_facts(spark, sf_dir))


@query
def flag_distribution_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = loaded_warehouse(spark, sf_dir).table("fact_unusual_activity")
    return summaries.flag_distribution_of_rows(activity)


@query
def call_put_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.call_put_activity(_facts(spark, sf_dir))


@query
def call_put_unusual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.call_put_unusual(_facts(spark, sf_dir))


@query
def avg_iv_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.average_iv_by_symbol(_facts(spark, sf_dir))


@query
def intraday_unusual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.unusual_by_hour(_facts(spark, sf_dir))


@query
def intraday_unusual_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.unusual_by_hour(_facts(spark, sf_dir), "unusual_event_count")


@query
def top_unusual_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rankings.top_unusual_contracts(_facts(spark, sf_dir)))


@query
def top_unusual_contracts_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rankings.top_unusual_contracts_script(_facts(spark, sf_dir)))


@query
def highest_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rankings.highest_ratio(_facts(spark, sf_dir)))


@query
def highest_ratio_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rankings.highest_ratio_script(_facts(spark, sf_dir)))


@query
def top_symbols_by_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rankings.top_symbols_by_volume(_facts(spark, sf_dir))


@query
def top_symbols_by_volume_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rankings.top_symbols_by_volume_script(_facts(spark, sf_dir))


# ---- history ------------------------------------------------------------------------


def _history(spark: SparkSession, sf_dir: str, keys: tuple[str, ...]) -> DataFrame:
    """Moments per key and day: written for all events, then once more for the first ten days."""

    def build(folder: str) -> str:
        typed = with_types(batch_events(spark, sf_dir))
        history.update_history(typed, folder, keys)
        first_days = typed.filter(F.col("event_date") < F.lit("2024-01-11").cast("date"))
        history.update_history(first_days, folder, keys)
        return folder

    folder = _once(spark, sf_dir, "history-" + "-".join(keys), build)
    return history.read_history(spark, folder, keys)


@query
def contract_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, sum and sum of squares of volumes per contract and day; replayed days are replaced."""
    moments = _history(spark, sf_dir, baseline.CONTRACT)
    return plain(
        moments.select(
            "contract_symbol",
            "event_date",
            "n",
            F.col("total").cast("bigint").alias("total"),
            F.col("squares").cast("bigint").alias("squares"),
        )
    )


@query
def contract_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's volume against its contract's twenty days before."""
    typed = with_types(batch_events(spark, sf_dir))
    scored = baseline.against_baseline(typed, _history(spark, sf_dir, baseline.CONTRACT))
    return scored.select("event_id", "base_n", "z_score", "above_baseline")


@query
def symbol_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's volume against its symbol's and option type's five days before."""
    keys = ("symbol", "option_type")
    typed = with_types(batch_events(spark, sf_dir))
    moments = _history(spark, sf_dir, keys)
    scored = baseline.against_baseline(typed, moments, keys, days=5, min_events=10, limit=1.5)
    return scored.select("event_id", "base_n", "z_score", "above_baseline")


def _corrected(spark: SparkSession, sf_dir: str) -> str:
    """The events in days, then a correction: some volumes change, some events move to the next day, some go."""

    def build(folder: str) -> str:
        columns = ["event_id", "contract_symbol", "volume", "event_timestamp", "event_date"]
        typed = with_types(batch_events(spark, sf_dir)).select(*columns)
        backfill.write_days(typed, f"{folder}/days")
        history.update_history(typed, f"{folder}/history")
        last = F.col("volume") % 10
        changed = typed.filter(last.isin(3, 7)).withColumns(
            {
                "event_date": F.when(last == 3, F.date_add("event_date", 1)).otherwise(F.col("event_date")),
                "volume": F.when(last == 7, F.col("volume") + 1000).otherwise(F.col("volume")),
            }
        )
        gone = typed.filter(last == 5).select("event_id")
        backfill.backfill(changed, f"{folder}/days", "first", gone, f"{folder}/history")
        return folder

    return _once(spark, sf_dir, "backfill", build)


@query
def backfilled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(backfill.read_days(spark, f"{_corrected(spark, sf_dir)}/days").drop("event_timestamp"))


@query
def backfilled_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    moments = history.read_history(spark, f"{_corrected(spark, sf_dir)}/history")
    whole = [F.col(name).cast("bigint").alias(name) for name in ("total", "squares")]
    return plain(moments.select("contract_symbol", "event_date", "n", *whole))


@query
def daily_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null shares and drift of every field of the raw events, valid or not, day by day."""
    return plain(drift.daily_checks(drift.daily_profile(_parsed(spark, sf_dir)), days=3, limit=100_000, min_rows=20))


@query
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How old the latest event of each symbol is at a given time."""
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return drift.freshness(_parsed(spark, sf_dir), now, 3600, by="symbol")


# ---- streaming and simulation -------------------------------------------------------


@query
def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consumer.route(_parsed(spark, sf_dir)).select("event_id", "route")


def consumed_stream(spark: SparkSession, sf_dir: str) -> str:
    """All events through the streaming consumer; returns its output folder."""

    def build(folder: str) -> str:
        run = consumer.start_consumer(
            spark,
            raw_folder(spark, sf_dir),
            f"{folder}/out",
            f"{folder}/checkpoint",
            max_files_per_trigger=1024,
            log=True,
        )
        run.awaitTermination()
        return f"{folder}/out"

    return _once(spark, sf_dir, "stream", build)


@query
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(consumer.read_alerts(spark, consumed_stream(spark, sf_dir)))


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = consumer.read_quarantine(spark, consumed_stream(spark, sf_dir))
    parsed = F.from_json("value", f"event_id string, {ERRORS} array<string>")
    record = lines.select(parsed.alias("record"))
    return record.select(
        "record.event_id", F.array_join(f"record.{ERRORS}", ";").alias(ERRORS)
    )


@query
def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = consumer.read_log(spark, consumed_stream(spark, sf_dir))
    return lines.select(F.col("value").alias("status_line"))


def _compacted_stream(spark: SparkSession, sf_dir: str) -> str:
    """All events in many batches, packed into generations twice, the first files removed in between."""

    def build(folder: str) -> str:
        source, out = f"{folder}/in", f"{folder}/out"
        options_lines(spark, sf_dir, parts=8).write.text(source)
        for files, least in ((2, 2), (1000, 1)):
            run = consumer.start_consumer(
                spark, source, out, f"{folder}/checkpoint", max_files_per_trigger=files, log=True
            )
            run.awaitTermination()
            compaction.compact(spark, out, min_batches=least)
            compaction.remove_compacted(spark, out, older_than_hours=0)
            # the second delivery: one file without events, so that the last batch is finished
            spark.createDataFrame([], "value string").coalesce(1).write.mode("append").text(source)
        return out

    return _once(spark, sf_dir, "compacted", build)


@query
def compacted_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(consumer.read_alerts(spark, _compacted_stream(spark, sf_dir)))


@query
def compacted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = consumer.read_log(spark, _compacted_stream(spark, sf_dir))
    return lines.select(F.col("value").alias("status_line"))


@query
def flags_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags as piped text, `NONE` where there are none."""
    flags = F.col("unusual_activity_flags")
    text = F.when(F.size(flags) > 0, piped_flags(flags)).otherwise("NONE")
    return batch_events(spark, sf_dir).select("event_id", text.alias("flags"))


def _delivered_twice(spark: SparkSession, sf_dir: str) -> str:
    """All events as JSON-lines files, and all again in other files."""

    def build(folder: str) -> str:
        options_lines(spark, sf_dir).write.option("maxRecordsPerFile", 1_000_000).text(folder)
        options_lines(spark, sf_dir, parts=3).write.mode("append").text(folder)
        return folder

    return _once(spark, sf_dir, "twice", build)


@query
def replayed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a stream that delivers every event twice, with a restart in between."""

    def build(folder: str) -> str:
        for _ in range(2):
            stream = consumer.read_stream(spark, _delivered_twice(spark, sf_dir), 4)
            run = alerts.start_alerts(stream, f"{folder}/out", f"{folder}/checkpoint", delay="400 days")
            run.awaitTermination()
        return f"{folder}/out"

    return plain(alerts.read_alerts(spark, _once(spark, sf_dir, "replayed-alerts", build)))


@query
def distinct_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch form over the same files."""
    lines = read_lines(spark, _delivered_twice(spark, sf_dir), with_order=True)
    first = alerts.distinct_alerts(alerts.alert_lines(lines))
    return first.select("event_id", F.unix_micros("event_time").alias("event_micros"))


def _rated_stream(spark: SparkSession, sf_dir: str) -> str:
    """Counts by symbol and hour of a stream whose files are in no order of time."""

    def build(folder: str) -> str:
        options_lines(spark, sf_dir, parts=6).write.text(f"{folder}/in")
        for files in (2, 1000):
            stream = consumer.read_stream(spark, f"{folder}/in", files)
            run = rates.start_rates(stream, f"{folder}/out", f"{folder}/checkpoint", by="symbol")
            run.awaitTermination()
        return f"{folder}/out"

    return _once(spark, sf_dir, "rates", build)


@query
def stream_quarantine_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.read_rates(spark, _rated_stream(spark, sf_dir), "symbol")


@query
def quarantine_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch form over the lines of the batch job."""
    return rates.quarantine_rates(read_lines(spark, raw_folder(spark, sf_dir)), "symbol")


@query
def quarantine_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours with twice the rate of the 48 hours before."""
    found = rates.read_rates(spark, _rated_stream(spark, sf_dir), "symbol")
    return rates.spikes(found, "symbol", 48 * 3600, factor=2, min_invalid=1)
