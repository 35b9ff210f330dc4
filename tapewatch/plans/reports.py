"""The four CSV reports over enriched events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tapewatch.operators.rankings import (
    CONTRACT_COLUMNS,
    DEFAULT_LIMIT,
    top_unusual_contracts_report,
)
from tapewatch.operators.summaries import flag_distribution, option_type_summary, symbol_summary
from tapewatch.sources.tables import counted, write_csv

_MEASURES = [
    "total_events",
    "unusual_events",
    "unusual_event_pct",
    "total_volume",
    "avg_implied_volatility",
    "avg_unusual_activity_score",
]

# Columns of each report file, in file order.
REPORT_COLUMNS: dict[str, list[str]] = {
    "top_unusual_contracts": [*CONTRACT_COLUMNS, "unusual_activity_flags"],
    "symbol_summary": ["symbol", *_MEASURES],
    "flag_distribution": ["flag", "count"],
    "option_type_summary": ["option_type", *_MEASURES],
}


def reports(enriched: DataFrame, limit: int = DEFAULT_LIMIT) -> dict[str, DataFrame]:
    return {
        "top_unusual_contracts": top_unusual_contracts_report(enriched, limit),
        "symbol_summary": symbol_summary(enriched),
        "flag_distribution": flag_distribution(enriched),
        "option_type_summary": option_type_summary(enriched),
    }


def write_reports(
    enriched: DataFrame, output_dir: str, limit: int = DEFAULT_LIMIT
) -> dict[str, int]:
    """Write each report to its own CSV folder; returns the rows written.

    Each report scans only its own columns, so read `enriched` from Parquet rather than
    from JSON when it is large.
    """
    written = {}
    for name, report in reports(enriched, limit).items():
        rows, observation = counted(report)
        write_csv(rows, f"{output_dir}/{name}", REPORT_COLUMNS[name])
        written[name] = observation.get["rows"]
    return written
