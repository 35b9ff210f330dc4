"""Counters of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewatch.functions.activity import is_unusual
from tapewatch.plans.batch import classify

METRICS = ["records_read", "valid_records", "invalid_records", "unusual_records"]


def run_metrics(events: DataFrame) -> DataFrame:
    """(metric, value) rows of one pass over parsed raw events."""
    valid = F.col("is_valid")
    totals = classify(events).agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(valid).alias("valid_records"),
        F.count_if(~valid).alias("invalid_records"),
        F.count_if(valid & is_unusual()).alias("unusual_records"),
    )
    return totals.unpivot([], METRICS, "metric", "value")
