"""Keys that a table holds, bucketed by their hash.

Spark reads bucketed files as already dealt out by key, so a join with a batch that is dealt into as
many buckets moves the batch only, however long the history is. Each load adds files to every bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PART = "attempt"


def write_bucketed(rows: DataFrame, folder: str, keys: Sequence[str], buckets: int) -> None:
    """Write `rows` to a new folder as one file per bucket of `keys`, sorted by them."""
    spark = rows.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    try:
        dealt.format("parquet").option("path", folder).saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the name only: the files are the user's


@contextmanager
def bucketed_keys(
    spark: SparkSession, folders: Sequence[str], types: dict[str, str], keys: Sequence[str], buckets: int
) -> Iterator[DataFrame | None]:
    """The `keys` in `folders` that `write_bucketed` filled, as a bucketed scan; None without a folder.

    The frame must be used within the block: Spark knows the buckets by a table that is dropped then.
    """
    if not folders:
        yield None
        return
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"{key} {types[key]}" for key in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, {_PART} INT) USING parquet PARTITIONED BY ({_PART}) "
        f"CLUSTERED BY ({', '.join(keys)}) INTO {buckets} BUCKETS LOCATION '{folders[0]}'"
    )
    try:
        parts = " ".join(f"PARTITION ({_PART}={i}) LOCATION '{folder}'" for i, folder in enumerate(folders))
        spark.sql(f"ALTER TABLE {name} ADD {parts}")
        yield spark.table(name).select(*keys)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def unheld(batch: DataFrame, held: DataFrame | None, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows of `batch` whose key is not in `held`; keys are unique in it and not null.

    `held` is first cut to the keys of the batch. Spark broadcasts those if its own estimate allows;
    otherwise the batch is dealt into the buckets of `held`, and `held` stays where it is.
    """
    if held is None:
        return batch
    wanted = batch.select(*keys).repartition(buckets, *keys)
    found = held.join(wanted, list(keys), "left_semi").withColumn("_held", F.lit(True))
    # an outer join: an anti join would be moved below the repartition and deal out `held` anew
    dealt = batch.repartition(buckets, *keys).join(found, list(keys), "left")
    return dealt.filter(F.col("_held").isNull()).drop("_held")


def without_held(dealt: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `dealt`, which lie in the buckets of `held`, whose key is not in `held`.

    For batches too large for a broadcast: neither side moves, and `dealt` is computed once.
    """
    marked = dealt.join(held.withColumn("_held", F.lit(True)), list(keys), "left")
    return marked.filter(F.col("_held").isNull()).drop("_held")
