"""Unusual-activity flags, score and volume/open-interest ratio."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapewatch.functions.rounding import ratio4

# Flag names, in the order an event lists them.
HIGH_VOLUME = "HIGH_VOLUME"
VOLUME_EXCEEDS_OPEN_INTEREST = "VOLUME_EXCEEDS_OPEN_INTEREST"
HIGH_IV = "HIGH_IV"


@dataclass(frozen=True)
class Thresholds:
    """Inclusive limits at which a flag is raised."""

    volume: int = 5000
    volume_to_open_interest: float = 1.0
    implied_volatility: float = 0.80


DEFAULT_THRESHOLDS = Thresholds()


def activity_flags(thresholds: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """Array of the raised flags. Built without a lambda so that it stays in generated code."""
    share = F.try_divide(F.col("volume"), F.col("open_interest"))
    raised = {
        HIGH_VOLUME: F.col("volume") >= thresholds.volume,
        VOLUME_EXCEEDS_OPEN_INTEREST: (F.col("open_interest") > 0)
        & (share >= thresholds.volume_to_open_interest),
        HIGH_IV: F.col("implied_volatility") >= thresholds.implied_volatility,
    }
    slots = [F.when(condition, name).otherwise("") for name, condition in raised.items()]
    return F.array_remove(F.array(*slots), "")


def volume_open_interest_ratio() -> Column:
    return ratio4(F.col("volume"), F.col("open_interest"))


def is_unusual() -> Column:
    """True for a positive score. A missing score gives null, which filters and counts skip;
    wrapping it in a coalesce would keep the filter from reaching the scan.
    """
    return F.col("unusual_activity_score") > 0
