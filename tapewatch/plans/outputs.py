"""All reports and marts of one layer, with one scan for the summaries.

Written apart, the four reports and four marts scan the events eight times. Here the cells are
written first, from one scan; the six summaries read them. The unusual events are the second scan,
filtered in the reader, and the ranking of contracts reads what that wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tapewatch.operators import cells as of
from tapewatch.operators.enrich import unusual_events, with_types
from tapewatch.operators.rankings import DEFAULT_LIMIT, top_unusual_contracts_report
from tapewatch.plans.reports import REPORT_COLUMNS
from tapewatch.sources.tables import counted, gathered, write_csv, write_parquet

CELLS = "activity_cells"


def reports_of(cells: DataFrame, unusual: DataFrame, limit: int = DEFAULT_LIMIT) -> dict[str, DataFrame]:
    """The four reports from cells and unusual events."""
    return {
        "top_unusual_contracts": top_unusual_contracts_report(unusual, limit),
        "symbol_summary": of.symbol_summary_of_cells(cells),
        "flag_distribution": of.flag_distribution_of_cells(cells),
        "option_type_summary": of.option_type_summary_of_cells(cells),
    }


def summary_marts_of(cells: DataFrame) -> dict[str, DataFrame]:
    """The three marts that are summaries."""
    return {
        "symbol_daily_summary": of.summary_of_cells(cells, "symbol", "event_date"),
        "flag_summary": of.flag_distribution_of_cells(cells, "flag_count"),
        "option_type_summary": of.option_type_summary_of_cells(cells),
    }


def write_outputs(
    enriched: DataFrame,
    reports_dir: str,
    marts_dir: str,
    limit: int = DEFAULT_LIMIT,
    partition_events_by: Sequence[str] = (),
) -> dict[str, int]:
    """Write every report (CSV) and mart (Parquet), and the cells beside the marts.

    Files hold what `write_reports` and `write_marts` write. Returns the rows written, by
    `reports/<name>` and `marts/<name>`. A run that died is run again as a whole.
    """
    spark = enriched.sparkSession
    typed = with_types(enriched)
    written = {}

    def write_mart(name: str, rows: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        rows, observation = counted(gathered(rows, partition_by))
        write_parquet(rows, f"{marts_dir}/{name}", partition_by=partition_by)
        written[f"marts/{name}"] = observation.get["rows"]
        # the layout is known: a mart without rows can be read as well
        return spark.read.schema(rows.schema).parquet(f"{marts_dir}/{name}")

    cells = write_mart(CELLS, of.activity_cells(typed))
    unusual = write_mart("unusual_events", unusual_events(typed), partition_events_by)
    for name, mart in summary_marts_of(cells).items():
        write_mart(name, mart)
    for name, report in reports_of(cells, unusual, limit).items():
        rows, observation = counted(report)
        write_csv(rows, f"{reports_dir}/{name}", REPORT_COLUMNS[name])
        written[f"reports/{name}"] = observation.get["rows"]
    return written
