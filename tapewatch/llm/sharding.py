"""Proportional stratified interleaving: shards that all match the mixture of sources.

Rows of a source are shuffled by a seeded digest of their id and ranked; the row of rank r (from
0) of n stands at (r + 1/2) / n. Sorted by this fraction, every stretch of the order holds each
source in its share of the whole. The order is cut into shards whose row counts differ by one at
most.

Ranks come from two distributed sorts of narrow rows (no text): a row's position is the number of
rows in the partitions before its own plus its place there. A source with a third of all rows is
spread over many partitions like any other; only one count per partition passes the driver.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewatch.llm.support import cut, long_literals, unused

SHARDS = 8
SEED = 20


def with_position(rows: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """`rows`, written sorted by `order`, with the global position from 0 as `name`."""
    place = unused(rows, "place")
    placed = cut(rows.orderBy(*order).withColumn(place, F.monotonically_increasing_id()))
    part = F.shiftright(place, 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).collect()
    sizes = {row["part"]: row["rows"] for row in counts}
    # one entry per partition of the sort: a number of the session's setting, not of the rows
    before = [0, *accumulate(sizes.get(i, 0) for i in range(max(sizes, default=0)))]
    start = long_literals(before)[part.cast("int")]
    inside = F.col(place).bitwiseAND(F.lit(2**33 - 1))
    return placed.withColumn(name, start + inside).drop(place)


def shard_rows(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    id_column: str = "doc_id",
    group_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, source, shard and slot.

    `size` is the text's UTF-8 bytes plus 1 (null: 1, its CRC-32 that of no bytes). Slots run from 0
    without a gap in each shard. Rows without a source form a source of their own; rows without an id
    are shuffled like any other. Ties in the shuffle are broken by id, CRC and size; rows equal in
    all of these are interchangeable. An empty table gives no rows; other columns are not read.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.col(group_column).alias("source"),
    )
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).cast("binary"))
    ties = ["doc_id", "text_crc32", "size"]
    sorted_rows = with_position(narrow.withColumn("key", key), ["source", "key", *ties], "at")
    sources = sorted_rows.groupBy(F.col("source").alias("of")).agg(
        F.min("at").alias("first"), F.count("*").alias("rows")
    )
    placed = sorted_rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id",
        "size",
        "text_crc32",
        "source",
        "key",
        ((F.col("at") - F.col("first") + 0.5) / F.col("rows")).alias("fraction"),
    )
    ordered = with_position(placed, ["fraction", "source", "key", *ties], "at")
    total = ordered.count()
    shard = F.expr(f"(at * {shards}L) div {max(total, 1)}L")
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return (
        ordered.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("at") - first)
        .select("doc_id", "size", "text_crc32", "source", "shard", "slot")
    )


def write_shards(docs: DataFrame, assignment: DataFrame, folder: str, id_column: str = "doc_id") -> None:
    """`docs` with unique ids written to one folder per shard, `shard=N`, rows in slot order per file."""
    docs.join(
        assignment.select(F.col("doc_id").alias(id_column), "shard", "slot"), id_column
    ).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.mode(
        "overwrite"
    ).option("partitionOverwriteMode", "static").partitionBy("shard").parquet(folder)
