"""Grouped summaries.

All measures combine map-side, so a hot symbol costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewatch.functions.activity import is_unusual
from tapewatch.functions.iso import hour_start
from tapewatch.functions.rounding import mean4, quotient4
from tapewatch.operators.enrich import unusual_events


def activity_summary(events: DataFrame, *keys: str, with_score: bool = True) -> DataFrame:
    """Counts, unusual share, volume and averages per key. Unordered."""
    measures: dict[str, Column] = {
        "total_events": F.count(F.lit(1)),
        "unusual_events": F.count_if(is_unusual()),
        "total_volume": F.sum(F.col("volume").cast("bigint")),
        "avg_implied_volatility": mean4(F.col("implied_volatility")),
    }
    if with_score:
        score = F.col("unusual_activity_score")
        measures["avg_unusual_activity_score"] = quotient4(F.sum(score), F.count(score))
    grouped = events.groupBy(*keys).agg(*[c.alias(name) for name, c in measures.items()])
    columns = [
        *keys,
        "total_events",
        "unusual_events",
        quotient4(F.col("unusual_events"), F.col("total_events")).alias("unusual_event_pct"),
        "total_volume",
        "avg_implied_volatility",
    ]
    if with_score:
        columns.append("avg_unusual_activity_score")
    return grouped.select(*columns)


def symbol_summary(events: DataFrame) -> DataFrame:
    """Ties in the two sort keys are broken by symbol."""
    return activity_summary(events, "symbol").orderBy(
        F.desc("unusual_events"), F.desc("total_volume"), F.asc("symbol")
    )


def symbol_daily_summary(typed_events: DataFrame) -> DataFrame:
    return activity_summary(typed_events, "symbol", "event_date")


def option_type_summary(events: DataFrame) -> DataFrame:
    return activity_summary(events, "option_type").orderBy("option_type")


def call_put_activity(events: DataFrame) -> DataFrame:
    """Option-type summary without the average score."""
    return activity_summary(events, "option_type", with_score=False).orderBy("option_type")


def call_put_unusual(events: DataFrame) -> DataFrame:
    return (
        unusual_events(events)
        .groupBy("option_type")
        .agg(
            F.count(F.lit(1)).alias("unusual_event_count"),
            F.sum(F.col("volume").cast("bigint")).alias("total_volume"),
        )
        .orderBy("option_type")
    )


def unusual_count_by_symbol(events: DataFrame) -> DataFrame:
    return (
        unusual_events(events)
        .groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("unusual_event_count"))
        .orderBy(F.desc("unusual_event_count"), F.asc("symbol"))
    )


def average_iv_by_symbol(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("symbol")
        .agg(mean4(F.col("implied_volatility")).alias("avg_implied_volatility"))
        .orderBy(F.desc("avg_implied_volatility"), F.asc("symbol"))
    )


def unusual_by_hour(events: DataFrame, count_name: str = "unusual_events") -> DataFrame:
    """`event_hour` is the timestamp cut to the hour, not the hour of day."""
    return (
        unusual_events(events)
        .groupBy(hour_start(F.col("event_timestamp")).alias("event_hour"))
        .agg(F.count(F.lit(1)).alias(count_name))
        .orderBy("event_hour")
    )


def distinct_symbols(events: DataFrame) -> DataFrame:
    return events.select("symbol").distinct().orderBy("symbol")


def _flag_counts(flags: DataFrame, count_name: str) -> DataFrame:
    return (
        flags.groupBy("flag")
        .agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(F.desc(count_name), F.asc("flag"))
    )


def flag_distribution(enriched: DataFrame, count_name: str = "count") -> DataFrame:
    """Events per flag, from the flag arrays."""
    flags = enriched.select(F.explode("unusual_activity_flags").alias("flag"))
    return _flag_counts(flags.filter(F.col("flag").isNotNull()), count_name)


def flag_distribution_of_rows(activity: DataFrame) -> DataFrame:
    """Events per flag, from one row per event and flag."""
    return _flag_counts(activity, "flag_count")
