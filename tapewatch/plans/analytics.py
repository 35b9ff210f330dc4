"""The analytics queries over the warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tapewatch.operators import rankings, summaries
from tapewatch.operators.rankings import DEFAULT_LIMIT


def analytics(tables: Mapping[str, DataFrame], limit: int = DEFAULT_LIMIT) -> dict[str, DataFrame]:
    """The seven queries of the analytics run, by title."""
    events = tables["fact_options_event"]
    activity = tables["fact_unusual_activity"]
    return {
        "Top Unusual Contracts": rankings.top_unusual_contracts(events, limit),
        "Unusual Activity Count By Symbol": summaries.symbol_summary(events),
        "Flag Distribution": summaries.flag_distribution_of_rows(activity),
        "Call Vs Put Unusual Activity": summaries.call_put_activity(events),
        "Highest Volume/Open Interest Ratio Contracts": rankings.highest_ratio(events, limit),
        "Intraday Unusual Activity Count By Hour": summaries.unusual_by_hour(events),
        "Top Symbols By Total Volume": rankings.top_symbols_by_volume(events, limit),
    }


def script_analytics(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The eight ad-hoc queries, in script order."""
    events = tables["fact_options_event"]
    activity = tables["fact_unusual_activity"]
    return {
        "top_unusual_contracts": rankings.top_unusual_contracts_script(events),
        "unusual_count_by_symbol": summaries.unusual_count_by_symbol(events),
        "flag_distribution": summaries.flag_distribution_of_rows(activity),
        "call_put_unusual": summaries.call_put_unusual(events),
        "highest_ratio": rankings.highest_ratio_script(events),
        "average_iv_by_symbol": summaries.average_iv_by_symbol(events),
        "unusual_by_hour": summaries.unusual_by_hour(events, "unusual_event_count"),
        "top_symbols_by_volume": rankings.top_symbols_by_volume_script(events),
    }
