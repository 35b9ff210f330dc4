"""Validate-and-enrich batch job.

Valid and quarantined rows leave in one map-only pass, as two directory partitions of one
output. Writing them as two separate jobs would parse the whole input twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapewatch.functions.activity import DEFAULT_THRESHOLDS, Thresholds, is_unusual
from tapewatch.operators.enrich import enrich
from tapewatch.operators.first_wins import SOURCE_ORDER
from tapewatch.operators.validate import ERRORS, is_valid, with_validation_errors
from tapewatch.schema import DERIVED_FIELDS, ENRICHED_FIELDS, ENRICHED_SCHEMA
from tapewatch.sources.jsonl import (
    enriched_text,
    parse_enriched,
    quarantine_text,
    read_events,
    strip_lines,
)

VALID = "valid"
INVALID = "invalid"
ROUTE = "route"


# Whatever the session's overwrite mode: a route without rows must not keep those of an earlier run.
REPLACE_ALL = {"partitionOverwriteMode": "static"}


@contextmanager
def unsorted_partition_writes(spark: SparkSession, writers: int = 8) -> Iterator[None]:
    """Let a task keep one file open per route instead of sorting its rows by route first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), writers)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def classify(events: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Every event with `is_valid`, its errors if not valid and the derived fields if valid."""
    checked = events.withColumn("is_valid", is_valid(events))
    valid = F.col("is_valid")
    enriched = enrich(with_validation_errors(checked, only=~valid), thresholds)
    return enriched.withColumns({name: F.when(valid, F.col(name)) for name in DERIVED_FIELDS})


@dataclass(frozen=True)
class BatchCounts:
    read: int
    valid: int
    invalid: int
    unusual: int


def run_batch(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    fmt: str = "parquet",
    thresholds: Thresholds = DEFAULT_THRESHOLDS,
    fail_fast: bool = False,
) -> BatchCounts:
    """Write `output_path/route=valid` and `output_path/route=invalid`.

    `fmt="parquet"` is the layer other jobs should read; `"jsonl"` keeps unknown fields
    of the input as well. The Parquet layer also keeps each row's place in the input
    (`source_order`), which decides ties of later loads.
    """
    with_order = fmt == "parquet"
    events = classify(read_events(spark, input_path, with_order, fail_fast), thresholds)
    valid = F.col("is_valid")
    route = F.when(valid, VALID).otherwise(INVALID).alias(ROUTE)
    if fmt == "jsonl":
        columns = [F.when(valid, enriched_text()).otherwise(quarantine_text()).alias("value")]
    elif fmt == "parquet":
        line = F.when(~valid, F.col("value")).alias("value")
        columns = [*ENRICHED_FIELDS, line, F.col(ERRORS), SOURCE_ORDER]
    else:
        raise ValueError(f"unknown format: {fmt}")
    observation = Observation()
    rows = events.observe(
        observation,
        F.count(F.lit(1)).alias("read"),
        F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("invalid"),
        F.count_if(valid & is_unusual()).alias("unusual"),
    ).select(route, *columns)
    with unsorted_partition_writes(spark):
        writer = rows.write.mode("overwrite").partitionBy(ROUTE).options(**REPLACE_ALL)
        writer.text(output_path) if fmt == "jsonl" else writer.parquet(output_path)
    return BatchCounts(**observation.get)


_STORED = ", ".join(
    [
        *(f"{field.name} {field.dataType.simpleString()}" for field in ENRICHED_SCHEMA.fields),
        f"value string, {ERRORS} array<string>",
        f"{SOURCE_ORDER} struct<file: string, block: bigint, line: bigint>",
        f"{ROUTE} string",
    ]
)


def read_route(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Lines (`value`) of one route of a text output; none if nothing was written to it yet."""
    stored = spark.read.schema("value string").text(path)
    there = F.col(ROUTE) == name if ROUTE in stored.columns else F.lit(False)
    return stored.filter(there).select("value")


def read_valid(
    spark: SparkSession, output_path: str, fmt: str = "parquet", with_order: bool = False
) -> DataFrame:
    """Enriched events of a finished batch; `with_order` adds each one's place in the input."""
    if fmt == "jsonl":
        if with_order:
            raise ValueError("only the Parquet layer keeps the order of the input")
        lines = strip_lines(read_route(spark, output_path, VALID))
        return parse_enriched(lines).select(*ENRICHED_FIELDS)
    stored = spark.read.schema(_STORED).parquet(output_path)
    order = [SOURCE_ORDER] if with_order else []
    return stored.filter(F.col(ROUTE) == VALID).select(*ENRICHED_FIELDS, *order)


def read_invalid(spark: SparkSession, output_path: str) -> DataFrame:
    """Quarantined lines of a finished Parquet batch, with their errors."""
    stored = spark.read.schema(_STORED).parquet(output_path)
    return stored.filter(F.col(ROUTE) == INVALID).select("value", ERRORS)
