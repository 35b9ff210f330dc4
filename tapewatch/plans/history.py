"""The stored history of daily moments, one Parquet folder per day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.operators.baseline import CONTRACT, daily_moments

#: Whatever the session's overwrite mode: only the days that are written are replaced.
REPLACE_DAYS = {"partitionOverwriteMode": "dynamic"}


def _layout(keys: Sequence[str]) -> str:
    return ", ".join(
        [*(f"`{key}` string" for key in keys), "n bigint, total decimal(38,0), squares decimal(38,0), event_date date"]
    )


def update_history(
    typed_events: DataFrame, folder: str, keys: Sequence[str] = CONTRACT, measure: str = "volume"
) -> None:
    """Writes the moments of the days that `typed_events` holds; each must hold its day whole.

    A day that was written before is replaced, so a replay changes nothing and a correction
    reaches that day only. Events must be distinct, as the facts of the warehouse are.
    """
    moments = daily_moments(typed_events, keys, measure)
    rows = moments.select(*keys, "n", "total", "squares", "event_date").hint("rebalance", "event_date")
    rows.write.mode("overwrite").options(**REPLACE_DAYS).partitionBy("event_date").parquet(folder)


def read_history(
    spark: SparkSession,
    folder: str,
    keys: Sequence[str] = CONTRACT,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Moments of the days from `first` to `last`; other days' folders are not opened."""
    rows = spark.read.schema(_layout(keys)).parquet(folder)
    if first is not None:
        rows = rows.filter(F.col("event_date") >= F.lit(first))
    if last is not None:
        rows = rows.filter(F.col("event_date") <= F.lit(last))
    return rows
