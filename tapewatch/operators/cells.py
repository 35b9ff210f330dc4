"""Activity cells: one scan of the events from which every summary follows.

A cell holds the sums of the events that share symbol, option type, day and flags. All measures of
the summaries can be merged, so a summary adds up cells instead of reading the events again; there
are at most as many cells as symbols times days times option types times combinations of flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewatch.functions.activity import is_unusual
from tapewatch.functions.rounding import quotient4

CELL_KEYS = ["symbol", "option_type", "event_date", "unusual_activity_flags"]


def activity_cells(typed_events: DataFrame) -> DataFrame:
    """Sums per cell of typed events. Sums are exact, so the order of the rows does not matter."""
    volatility = F.col("implied_volatility").cast("decimal(24,10)")
    score = F.col("unusual_activity_score")
    return typed_events.groupBy(*CELL_KEYS).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(is_unusual()).alias("unusual"),
        F.sum(F.col("volume").cast("bigint")).alias("volume"),
        F.sum(volatility).alias("volatility_sum"),
        F.count(volatility).alias("volatility_count"),
        F.sum(score).alias("score_sum"),
        F.count(score).alias("score_count"),
    )


def _total(name: str) -> Column:
    return F.sum(name).alias(name)


def summary_of_cells(cells: DataFrame, *keys: str) -> DataFrame:
    """As `summaries.activity_summary` over the events of the cells. Unordered."""
    sums = ["events", "unusual", "volume", "volatility_sum", "volatility_count", "score_sum", "score_count"]
    totals = cells.groupBy(*keys).agg(*[_total(name) for name in sums])
    return totals.select(
        *keys,
        F.col("events").alias("total_events"),
        F.col("unusual").alias("unusual_events"),
        quotient4(F.col("unusual"), F.col("events")).alias("unusual_event_pct"),
        F.col("volume").alias("total_volume"),
        quotient4(F.col("volatility_sum"), F.col("volatility_count")).alias("avg_implied_volatility"),
        quotient4(F.col("score_sum"), F.col("score_count")).alias("avg_unusual_activity_score"),
    )


def symbol_summary_of_cells(cells: DataFrame) -> DataFrame:
    return summary_of_cells(cells, "symbol").orderBy(
        F.desc("unusual_events"), F.desc("total_volume"), F.asc("symbol")
    )


def option_type_summary_of_cells(cells: DataFrame) -> DataFrame:
    return summary_of_cells(cells, "option_type").orderBy("option_type")


def flag_distribution_of_cells(cells: DataFrame, count_name: str = "count") -> DataFrame:
    """Events per flag: flags are taken apart per cell, not per event."""
    flags = cells.select(F.explode("unusual_activity_flags").alias("flag"), "events")
    counts = flags.filter(F.col("flag").isNotNull()).groupBy("flag")
    return counts.agg(F.sum("events").alias(count_name)).orderBy(F.desc(count_name), F.asc("flag"))
