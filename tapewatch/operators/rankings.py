"""Top-N queries. Rows are events, not contracts; `event_id` makes each order total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewatch.functions.rounding import quotient4
from tapewatch.functions.text import piped_flags
from tapewatch.operators.enrich import unusual_events

DEFAULT_LIMIT = 25

CONTRACT_COLUMNS = [
    "contract_symbol",
    "symbol",
    "option_type",
    "strike",
    "expiration_date",
    "volume",
    "open_interest",
    "volume_open_interest_ratio",
    "implied_volatility",
    "unusual_activity_score",
]


def _top_unusual(events: DataFrame, limit: int) -> DataFrame:
    ratio = F.coalesce(F.col("volume_open_interest_ratio"), F.lit(0))
    return (
        unusual_events(events)
        .orderBy(
            F.desc("unusual_activity_score"), F.desc("volume"), ratio.desc(), F.asc("event_id")
        )
        .limit(limit)
    )


def top_unusual_contracts_report(enriched: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Report form: flags as piped text."""
    flags = piped_flags(F.col("unusual_activity_flags")).alias("unusual_activity_flags")
    return _top_unusual(enriched, limit).select(*CONTRACT_COLUMNS, flags)


def top_unusual_contracts(events: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Warehouse form: with the event timestamp."""
    return _top_unusual(events, limit).select(*CONTRACT_COLUMNS, "event_timestamp")


def top_unusual_contracts_script(events: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return _top_unusual(events, limit).select(*CONTRACT_COLUMNS)


def _highest_ratio(events: DataFrame, limit: int) -> DataFrame:
    return (
        events.filter(F.col("volume_open_interest_ratio").isNotNull())
        .orderBy(F.desc("volume_open_interest_ratio"), F.desc("volume"), F.asc("event_id"))
        .limit(limit)
    )


def highest_ratio(events: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return _highest_ratio(events, limit).select(
        "contract_symbol",
        "symbol",
        "option_type",
        "volume",
        "open_interest",
        "volume_open_interest_ratio",
        "unusual_activity_score",
    )


def highest_ratio_script(events: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return _highest_ratio(events, limit).select(
        "contract_symbol",
        "symbol",
        "volume",
        "open_interest",
        "volume_open_interest_ratio",
        "unusual_activity_score",
    )


def _volume_by_symbol(events: DataFrame) -> DataFrame:
    return events.groupBy("symbol").agg(
        F.sum(F.col("volume").cast("bigint")).alias("total_volume"),
        F.count(F.lit(1)).alias("total_events"),
    )


def top_symbols_by_volume(events: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    average = quotient4(F.col("total_volume"), F.col("total_events"))
    return (
        _volume_by_symbol(events)
        .orderBy(F.desc("total_volume"), F.desc("total_events"), F.asc("symbol"))
        .limit(limit)
        .select("symbol", "total_volume", "total_events", average.alias("avg_volume_per_event"))
    )


def top_symbols_by_volume_script(events: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return (
        _volume_by_symbol(events)
        .orderBy(F.desc("total_volume"), F.asc("symbol"))
        .limit(limit)
        .select("symbol", "total_volume")
    )
