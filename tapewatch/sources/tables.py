"""Parquet and CSV tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Quotes inside a field are doubled and blanks at its ends kept, as CSV readers expect.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a directory partition together before a partitioned write.

    Without this every task writes a small file per directory. A rebalance rather than a
    repartition: adaptive execution splits a directory that holds a large share of the rows.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """CSV with a header, the given column order and nulls as empty fields; text stays as it is."""
    writer = df.select(*columns).write.mode(mode).options(**CSV_OPTIONS)
    writer.option("nullValue", "").option("emptyValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows on their way into a sink, without a second job.

    Apply it last before the write: there the count runs in the final stage, whose tasks
    Spark counts once however often they are retried.
    """
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
