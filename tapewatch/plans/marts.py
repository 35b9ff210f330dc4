"""The four Parquet marts over enriched events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tapewatch.operators.enrich import unusual_events, with_types
from tapewatch.operators.summaries import (
    flag_distribution,
    option_type_summary,
    symbol_daily_summary,
)
from tapewatch.sources.tables import counted, gathered, write_parquet


def marts(enriched: DataFrame) -> dict[str, DataFrame]:
    typed = with_types(enriched)
    return {
        "unusual_events": unusual_events(typed),
        "symbol_daily_summary": symbol_daily_summary(typed),
        "flag_summary": flag_distribution(typed, count_name="flag_count"),
        "option_type_summary": option_type_summary(typed),
    }


def write_marts(
    enriched: DataFrame, output_dir: str, partition_events_by: Sequence[str] = ()
) -> dict[str, int]:
    """Write each mart to its own Parquet folder; returns the rows written.

    `partition_events_by=["event_date"]` lets later reads of the unusual events prune by day.
    """
    written = {}
    for name, mart in marts(enriched).items():
        partition_by = partition_events_by if name == "unusual_events" else ()
        rows, observation = counted(gathered(mart, partition_by))
        write_parquet(rows, f"{output_dir}/{name}", partition_by=partition_by)
        written[name] = observation.get["rows"]
    return written
