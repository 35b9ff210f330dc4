"""Enrichment of valid events and the typed form used by the marts and the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewatch.functions.activity import (
    DEFAULT_THRESHOLDS,
    Thresholds,
    activity_flags,
    is_unusual,
    volume_open_interest_ratio,
)
from tapewatch.functions.iso import iso_date, iso_timestamp
from tapewatch.operators.validate import valid_events


def enrich(events: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Add flags, their number as the score, and the ratio; every other column is kept."""
    return events.withColumn("unusual_activity_flags", activity_flags(thresholds)).withColumns(
        {
            "unusual_activity_score": F.size("unusual_activity_flags"),
            "volume_open_interest_ratio": volume_open_interest_ratio(),
        }
    )


def process(events: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Valid events, enriched."""
    return enrich(valid_events(events), thresholds)


def with_types(enriched: DataFrame) -> DataFrame:
    """Parse the two ISO strings, pin the numeric types, add event date and hour of day.

    A value that does not fit its type becomes null instead of ending the job.
    """
    dtypes = dict(enriched.dtypes)
    typed = enriched.withColumns(
        {
            "event_timestamp": iso_timestamp(F.col("event_timestamp"))
            if dtypes["event_timestamp"] == "string"
            else F.col("event_timestamp"),
            "expiration_date": iso_date(F.col("expiration_date"))
            if dtypes["expiration_date"] == "string"
            else F.col("expiration_date"),
            "volume": F.col("volume").try_cast("int"),
            "open_interest": F.col("open_interest").try_cast("int"),
            "unusual_activity_score": F.col("unusual_activity_score").try_cast("int"),
            "implied_volatility": F.col("implied_volatility").try_cast("double"),
            "volume_open_interest_ratio": F.col("volume_open_interest_ratio").try_cast("double"),
            "underlying_price": F.col("underlying_price").try_cast("double"),
            "strike": F.col("strike").try_cast("double"),
        }
    )
    return typed.withColumns(
        {
            "event_date": F.to_date("event_timestamp"),
            "event_hour": F.hour("event_timestamp"),
        }
    )


def unusual_events(enriched: DataFrame) -> DataFrame:
    return enriched.filter(is_unusual())


def activity_rows(enriched: DataFrame, *extra: str) -> DataFrame:
    """One row per event and flag. `explode` (not outer) drops events without flags early."""
    rows = enriched.select(
        "event_id",
        "contract_symbol",
        "symbol",
        F.explode("unusual_activity_flags").alias("flag"),
        "event_timestamp",
        *extra,
    )
    return rows.filter(F.col("flag").isNotNull())
