"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. Equal blocks get the same integer name and
different blocks get different ones: blocks are dealt to 2^31 buckets by hash, sorted in their
bucket and ranked, and the name is bucket and rank. Adjacent names are then paired and the pairs
named in the same way, level by level, until each text has one name. Two texts have the same
number of levels and the same name if, and only if, all their bytes are equal: hashes only deal
blocks out, equality is decided by sorting whole blocks and whole pairs.

Blocks cross the network once, by their bucket. A block that many rows share would fill one
bucket, so the most frequent blocks are named beforehand and their rows stay where they are. Of
N blocks, none that is dealt out has more than N / 1024 rows; the list of frequent ones has at
most 1024 entries, a proven bound for its broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewatch.llm.support import HOT_KEYS, cut, with_group

BLOCK_BYTES = 2048
#: A block with fewer rows is never treated as frequent.
HOT_ROWS = 32


def normal_text(text: Column) -> Column:
    """Each run of blanks, tabs and line ends becomes one space; null becomes empty.

    Only runs that change are matched: those with a character other than a space, or over one long.
    """
    pattern = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), pattern, " ")


def with_names(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` with a BIGINT `name` in place of the columns `keys`: equal keys, equal names.

    Key columns hold no nulls.
    """
    place = F.xxhash64(*keys)
    frequent = [
        row["place"]
        for row in rows.groupBy(place.alias("place"))
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") >= HOT_ROWS)
        .orderBy(F.desc("rows"), "place")
        .limit(HOT_KEYS)
        .collect()
    ]
    bucket = F.shiftrightunsigned(place, 33)
    if not frequent:
        ranked = rows.withColumn("bucket", bucket)
        order = Window.partitionBy("bucket").orderBy(*keys)
        name = F.shiftleft(F.col("bucket"), 32).bitwiseOR(F.dense_rank().over(order).cast("long"))
        return ranked.withColumn("name", name).drop("bucket", *keys)

    # Frequent keys get the names -1, -2, ...; their rows keep their places in the shuffle below.
    hot = (
        rows.filter(place.isin(frequent))
        .groupBy(*keys)
        .agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), *keys)
        .limit(HOT_KEYS)
        .select(*keys, (-1 - F.monotonically_increasing_id()).alias("hot"))
    )
    known = rows.join(F.broadcast(hot), keys, "left")
    spread = F.pmod(F.xxhash64("row", "pos"), F.lit(2**31))
    own = [F.when(F.col("hot").isNull(), F.col(key)).alias(key) for key in keys]
    rest = [column for column in rows.columns if column not in keys]
    dealt = known.select(
        *rest, "hot", F.when(F.col("hot").isNull(), bucket).otherwise(spread).alias("bucket"), *own
    )
    order = Window.partitionBy("bucket").orderBy(*keys)
    name = F.shiftleft(F.col("bucket"), 32).bitwiseOR(F.dense_rank().over(order).cast("long"))
    return dealt.withColumn("name", F.coalesce("hot", name)).drop("bucket", "hot", *keys)


def text_identities(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Identity of the string column `text` of each row: (`level`, `name`), in place of the text.

    `rows` has a unique BIGINT `row`, a non-null `text` and columns to carry along; it must give
    the same rows each time it is computed.
    """
    carried = [column for column in rows.columns if column not in ("row", "text")]
    data = F.col("text").cast("binary")
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / block_bytes)).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)),
    )
    cut_up = rows.select("row", *carried, count.alias("size"), F.posexplode(blocks).alias("pos", "block"))
    first = F.col("pos") == 0
    kept = [F.when(first, F.col(column)).alias(column) for column in carried]
    named = cut(with_names(cut_up.select("row", "pos", "size", "block", *kept), ["block"]))

    level, done = 0, []
    longest = named.agg(F.max("size")).first()[0] or 1
    while True:
        single = named.filter(F.col("size") == 1) if longest > 1 else named
        done.append(single.select("row", F.lit(level).alias("level"), "name", *carried))
        if longest <= 1:
            break
        left = F.max(F.when(F.col("pos") % 2 == 0, F.col("name")))
        right = F.max(F.when(F.col("pos") % 2 == 1, F.col("name")))
        pairs = (
            named.filter(F.col("size") > 1)
            .groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("half"))
            .agg(
                left.alias("left"),
                F.coalesce(right, F.lit(0).cast("long")).alias("right"),  # 0 is no name
                F.max("size").alias("blocks"),
                *[F.max(column).alias(column) for column in carried],
            )
            .select(
                "row",
                F.col("half").alias("pos"),
                F.ceil(F.col("blocks") / 2).cast("int").alias("size"),
                "left",
                "right",
                *carried,
            )
        )
        named = cut(with_names(pairs, ["left", "right"]))
        level, longest = level + 1, (longest + 1) // 2
    together = done[0]
    for part in done[1:]:
        together = together.unionByName(part)
    return together


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when `normal_text` of them is. Null text counts as empty and empty texts are
    equal to each other. Of equal texts the row with the smallest id is kept, nulls last; of
    repeated rows with that same id exactly one is kept. `keep_id` is null only in a group without
    any id. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        normal_text(F.col(text_column)).alias("text"),
    ).select("row", "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "text")
    named = text_identities(rows, block_bytes)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row").alias("at"))
    groups = (
        named.groupBy("level", "name")
        .agg(F.min(place).alias("keep"), F.count("*").alias("group_size"))
        .select(
            "level",
            "name",
            F.col("keep.id").alias("keep_id"),
            F.col("keep.at").alias("keep_row"),
            "group_size",
        )
    )
    return with_group(named, cut(groups), ["level", "name"], "group_size").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256",
    )
