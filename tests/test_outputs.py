"""Reports and marts from cells: contents, and how often the events are read."""

from __future__ import annotations

from pathlib import Path

from helpers import SMALL, event, events_frame

from tapewatch.operators import cells as of
from tapewatch.operators import summaries
from tapewatch.operators.enrich import process, with_types
from tapewatch.plans import marts, outputs, reports
from tapewatch.sources.market_events import options_events


def rows(df):
    return sorted(map(repr, df.collect()))


def test_summaries_of_cells_equal_those_of_events(spark):
    enriched = process(options_events(spark, SMALL))
    typed = with_types(enriched)
    cells = of.activity_cells(typed)
    pairs = [
        (of.symbol_summary_of_cells(cells), summaries.symbol_summary(enriched)),
        (of.option_type_summary_of_cells(cells), summaries.option_type_summary(enriched)),
        (of.flag_distribution_of_cells(cells), summaries.flag_distribution(enriched)),
        (of.summary_of_cells(cells, "symbol", "event_date"), summaries.symbol_daily_summary(typed)),
    ]
    for found, expected in pairs:
        assert found.columns == expected.columns
        assert dict(found.dtypes) == dict(expected.dtypes)
        assert rows(found) == rows(expected)


def test_the_summaries_need_one_scan_of_the_events(spark, tmp_path):
    process(options_events(spark, SMALL)).write.parquet(f"{tmp_path}/in")
    cells = of.activity_cells(with_types(spark.read.parquet(f"{tmp_path}/in")))
    text = cells._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Expand" not in text
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text
    # combined before the shuffle: what is shuffled are cells
    assert text.index("Exchange") < text.index("partial_sum")


def csv_lines(folder):
    return sorted(line for file in Path(folder).glob("part-*") for line in file.read_text().splitlines())


def test_files_equal_those_written_apart(spark, tmp_path):
    enriched = process(options_events(spark, SMALL))
    written = outputs.write_outputs(
        enriched, f"{tmp_path}/r", f"{tmp_path}/m", limit=7, partition_events_by=["event_date"]
    )
    apart = reports.write_reports(enriched, f"{tmp_path}/r2", limit=7)
    for name, count in apart.items():
        assert written[f"reports/{name}"] == count
        assert csv_lines(tmp_path / "r" / name) == csv_lines(tmp_path / "r2" / name)
    for name, count in marts.write_marts(enriched, f"{tmp_path}/m2", ["event_date"]).items():
        assert written[f"marts/{name}"] == count
        found, expected = (spark.read.parquet(f"{tmp_path}/{side}/{name}") for side in ("m", "m2"))
        assert found.columns == expected.columns and rows(found) == rows(expected)
    # written again over the old files: the same
    again = outputs.write_outputs(enriched, f"{tmp_path}/r", f"{tmp_path}/m", 7, ["event_date"])
    assert again == written


def test_no_events_and_events_without_flags(spark, tmp_path):
    for name, given in {"none": ["{bad"], "quiet": [event()]}.items():
        enriched = process(events_frame(spark, given))
        written = outputs.write_outputs(enriched, f"{tmp_path}/{name}/r", f"{tmp_path}/{name}/m")
        quiet = len(given) if name == "quiet" else 0
        assert written["marts/unusual_events"] == written["reports/top_unusual_contracts"] == 0
        assert written["reports/flag_distribution"] == written["marts/flag_summary"] == 0
        assert written["reports/symbol_summary"] == written["marts/symbol_daily_summary"] == quiet
