"""First row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewatch.schema import ENRICHED_FIELDS

SOURCE_ORDER = "source_order"


def arrival_order(df: DataFrame) -> list[Column]:
    """Input order if the reader recorded it, else event time.

    The hash of the row breaks what ties remain, so two runs pick the same row.
    """
    if SOURCE_ORDER in df.columns:
        return [F.col(SOURCE_ORDER)]
    columns = [name for name in df.columns if name in ENRICHED_FIELDS or name == "flag"]
    order = [F.col(name) for name in ("event_timestamp", "event_id") if name in columns]
    return [*order, F.xxhash64(*sorted(columns))]


def first_per_key(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Keep the first row of each key.

    Spark turns `row_number() = 1` into a limit per key before the shuffle, so a key with
    a third of all rows sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*(order or arrival_order(df)))
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


CONTRACT_ATTRIBUTES = ["contract_symbol", "symbol", "option_type", "strike", "expiration_date"]


def contract_rows(events: DataFrame) -> DataFrame:
    """The columns that decide which contract attributes come first, and no others."""
    extra = [SOURCE_ORDER] if SOURCE_ORDER in events.columns else ["event_timestamp", "event_id"]
    return events.select(*CONTRACT_ATTRIBUTES, *extra)


def unique_contracts(events: DataFrame) -> DataFrame:
    """Attributes of each contract as first seen."""
    first = first_per_key(contract_rows(events), ["contract_symbol"])
    return first.select(*CONTRACT_ATTRIBUTES)
