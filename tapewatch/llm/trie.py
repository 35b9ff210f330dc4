"""Prefix trie of conversations, built as a burst trie.

A turn's id is a digest of its role and text; a conversation is the sequence of its turn ids.
Equal sequences become one path with a count. Paths lie in containers, each under a trie head (the
turns that all its paths share so far); at first all lie under the root. A container with more than
`container_paths` paths bursts: its head goes on through the turns that all its paths share, and
there each next turn id gets a container of its own. What remains in small containers is dealt to
shards by head, sorted, and swept once: a stack holds the open path, and a node is closed when the
next sequence leaves it. Sums over subtrees pass from the containers up through the burst heads.

Each burst looks at the rows of containers that are too large only, and divides them at a turn where
they do differ, so a long prefix that very many conversations share takes one round. Rows find the
few large heads by a salted join: a container with all rows is dealt to `SALTS` tasks. Texts are
digested where they are read and never cross the network.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewatch.llm.support import cut

#: A container with more paths bursts; what one shard holds of a container at once is bounded by it.
CONTAINER_PATHS = 256
SALTS = 16
#: Conversation ids of one path are put in order in blocks of 2^12 neighbouring numbers.
BLOCK_BITS = 12
DIGEST_BYTES = 16
ROWS = 4096

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_SWEPT = f"{NODE}, up string, round int"
_PATH = "seq array<binary>, n long, low long, ends string"


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes of the SHA-256 of role and text, then the text's UTF-8 length in 4 bytes."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * DIGEST_BYTES)
    return F.unhex(F.concat(digest, F.lpad(F.hex(F.octet_length(text)), 8, "0")))


def text_bytes(turn: Column) -> Column:
    """UTF-8 bytes of the text that a turn id stands for."""
    return F.conv(F.hex(F.substring(turn, DIGEST_BYTES + 1, 4)), 16, 10).cast("long")


def turn_sequences(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """(conv_id, seq): the turn ids of each conversation in order of turn, null first.

    Turns with the same number are ordered by their ids. Null roles and texts are empty ones. Rows
    without a conversation id belong to none and are left out.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in (role_column, text_column))
    rows = conversations.select(
        F.col(id_column).cast("long").alias("conv_id"),
        F.col(turn_column).isNotNull().alias("numbered"),
        F.coalesce(F.col(turn_column).cast("long"), F.lit(0)).alias("turn"),
        turn_id(role, text).alias("id"),
    ).filter(F.col("conv_id").isNotNull())
    turns = F.array_sort(F.collect_list(F.struct("numbered", "turn", "id")))
    return rows.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id", F.transform("turns", lambda turn: turn["id"]).alias("seq")
    )


def rebuilt_sequences(sequences: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, seq) with each beginning replaced by that of the first conversation of its group.

    Conversation c takes the first h turns of conversation c - c % group, h = crc32(c) % most, and
    then its own turns after its first h.
    """
    conv = F.col("conv_id")
    h = (F.crc32(conv.cast("string").cast("binary")) % most).cast("int")
    of_group = Window.partitionBy("base")
    head = F.max(F.when(conv == F.col("base"), F.slice("seq", 1, most))).over(of_group)
    none = F.array().cast("array<binary>")
    rest = F.slice("seq", h + 1, F.greatest(F.size("seq") - h, F.lit(0)))
    return (
        sequences.withColumn("base", conv - conv % group)
        .withColumn("head", F.coalesce(head, none))
        .select("conv_id", F.concat(F.slice("head", F.lit(1), h), rest).alias("seq"))
    )


def _merged_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence from its blocks of ids, which come one after the other in order."""
    schema = pa.schema(
        [("seq", pa.list_(pa.binary())), ("n", pa.int64()), ("low", pa.int64()), ("ends", pa.string())]
    )
    seq, n, low, digest, out = None, 0, 0, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if digest is None or row["seq"] != seq:
                if digest is not None:
                    out.append((seq, n, low, digest.hexdigest()))
                seq, n, low, digest = row["seq"], 0, row["low"], hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(row["ids"].encode())
            n += row["n"]
            if len(out) >= ROWS:
                yield _batch(out, schema)
                out = []
    if digest is not None:
        out.append((seq, n, low, digest.hexdigest()))
    yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
    )


def distinct_paths(sequences: DataFrame) -> DataFrame:
    """(seq, n, low, ends) per distinct sequence: conversations, smallest id, digest of their ids.

    The ids of a path meet as blocks that are already joined, at most 2^12 to a row, and pass
    through a running SHA-256, which by its nature takes them one after the other.
    """
    ids = F.array_sort(F.collect_list("conv_id"))
    blocks = (
        sequences.groupBy("seq", F.shiftright("conv_id", BLOCK_BITS).alias("block"))
        .agg(ids.alias("ids"))
        .select(
            "seq",
            "block",
            F.size("ids").cast("long").alias("n"),
            F.col("ids")[0].alias("low"),
            F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
        )
    )
    ordered = blocks.repartition("seq").sortWithinPartitions("seq", "block")
    return ordered.mapInArrow(_merged_paths, _PATH)


def _with_large(rows: DataFrame, large: DataFrame, how: str) -> DataFrame:
    """`rows` joined by `head` with the few `large` heads, each head's rows over `SALTS` tasks."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = F.pmod(F.xxhash64("low"), F.lit(SALTS)).cast("int")
    right = large.withColumn("salt", salts)
    return rows.withColumn("salt", salt).join(right, ["head", "salt"], how).drop("salt")


def _shared_turns(first: Column, last: Column) -> Column:
    """Number of turns at which two sequences agree from the start."""
    both = F.least(F.size(first), F.size(last))
    differ = F.filter(F.sequence(F.lit(0), both), lambda i: (i == both) | (F.get(first, i) != F.get(last, i)))
    return F.array_min(differ)


def _bursts(paths: DataFrame, container_paths: int) -> tuple[DataFrame, list[DataFrame]]:
    """(rows of small containers, heads that burst in each round)."""
    rows = paths.select(
        "*",
        F.lit("").alias("head"),
        F.lit(0).alias("at"),
        F.lit(None).cast("string").alias("up"),
        F.lit(None).cast("long").alias("up_low"),
        F.lit(0).alias("round"),
    )
    small, heads = [], []
    while True:
        large = cut(
            rows.groupBy("head").agg(F.count("*").alias("paths")).filter(F.col("paths") > container_paths).select("head")
        )
        if large.isEmpty():
            small.append(rows)
            break
        marked = cut(_with_large(rows, large.withColumn("large", F.lit(True)), "left"))
        small.append(marked.filter(F.col("large").isNull()).drop("large"))
        rows = marked.filter("large").drop("large")
        found = rows.groupBy("head").agg(
            F.min(F.struct("seq", "ends")).alias("first"),
            F.max("seq").alias("last"),
            F.sum("n").alias("n"),
            F.min("low").alias("low"),
            *[F.first(name).alias(name) for name in ("at", "up", "up_low", "round")],
        )
        shared = _shared_turns(F.col("first.seq"), F.col("last"))
        # the sequence that ends where the others go on is the smallest of them
        ended = F.when(F.size("first.seq") == F.col("to"), F.col("first.ends")).otherwise(EMPTY_SHA256)
        own = F.filter(F.col("first.seq"), lambda turn, i: (i >= F.col("at") - 1) & (i < F.col("to")))
        burst = cut(
            found.withColumn("to", shared).select(
                "head", "at", "to", "up", "up_low", "round", "n", "low",
                ended.alias("ends"),
                F.transform(own, text_bytes).alias("bytes"),
            )
        )
        heads.append(burst)
        above = burst.select("head", F.col("to"), F.col("low").alias("head_low"))
        through = F.array_join(F.transform(F.slice("seq", 1, F.col("to") + 1), F.hex), "")
        rows = cut(
            _with_large(rows, above, "inner")
            .filter(F.size("seq") > F.col("to"))
            .select(
                "seq", "n", F.col("low"), "ends",
                F.sha2(through.cast("binary"), 256).alias("head"),
                (F.col("to") + 1).alias("at"),
                F.col("head").alias("up"),
                F.col("head_low").alias("up_low"),
                (F.col("round") + 1).alias("round"),
            )
        )
    together = small[0]
    for part in small[1:]:
        together = together.unionByName(part)
    return together, heads


class _Node:
    """An open node: `kept` are finished records of its children that wait for its smallest member."""

    __slots__ = ("bytes", "children", "depth", "ends", "kept", "leaves", "low", "n", "saved")

    def __init__(self, depth: int, size: int):
        self.depth, self.bytes = depth, size
        self.n = self.children = self.leaves = self.saved = 0
        self.low, self.ends, self.kept = None, EMPTY_SHA256, []

    def joined(self, n: int, low: int) -> None:
        self.n += n
        self.low = low if self.low is None else min(self.low, low)

    def closed(self) -> tuple:
        """This node's record, the parent's conversation left open."""
        self.leaves = self.leaves or 1
        self.saved += (self.n - 1) * self.bytes
        return (self.low, self.depth, None, self.n, self.children, self.leaves, self.saved, self.ends)


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose rows come sorted by head and sequence; a container's top has `up`."""
    kinds = [pa.int64()] * 7 + [pa.string(), pa.string(), pa.int32()]
    names = [item.split()[0] for item in _SWEPT.split(", ")]
    schema = pa.schema(list(zip(names, kinds)))
    out: list[tuple] = []
    stack: list[_Node] = []
    place: dict = {}

    def close(depth: int) -> None:
        """Closes the open nodes below `depth`, and the container itself where that is above its head."""
        while stack and stack[-1].depth > depth:
            node = stack.pop()
            record = node.closed()
            out.extend((*child[:2], node.low, *child[3:], None, None) for child in node.kept)
            if stack:
                above = stack[-1]
                above.children += 1
                above.leaves += node.leaves
                above.saved += node.saved
                above.joined(node.n, node.low)
                above.kept.append(record)
            else:
                out.append((*record[:2], place["up_low"], *record[3:], place["up"], place["round"]))

    before: list[bytes] = []
    for batch in batches:
        for row in batch.to_pylist():
            seq, at = row["seq"], row["at"]
            if not stack or row["head"] != place["head"]:
                close(-1)
                place, shared = row, at - 1
            else:
                shared = at
                while shared < min(len(seq), len(before)) and seq[shared] == before[shared]:
                    shared += 1
                close(shared)
            for depth in range(shared + 1, len(seq) + 1):
                size = int.from_bytes(seq[depth - 1][DIGEST_BYTES:], "big") if depth else 0
                stack.append(_Node(depth, size))
            stack[-1].joined(row["n"], row["low"])
            stack[-1].ends, before = row["ends"], seq
            if len(out) >= ROWS:
                yield _batch(out, schema)
                out.clear()
    close(-1)
    yield _batch(out, schema)


def trie_nodes(sequences: DataFrame, container_paths: int = CONTAINER_PATHS) -> DataFrame:
    """The trie of `sequences` (conv_id, seq of turn ids), one row per node, see `NODE`.

    A node is a distinct beginning of sequences, its members those that have it; it is named by its
    smallest member and its depth, the root has depth 0 and no parent. `n_leaves` counts the
    childless nodes of its subtree, itself included, `saved_tokens` sums (members - 1) * text bytes
    over it, and `ends_sha256` is a digest of the members that end there. No sequence, no node.
    Ids are distinct and not null. A sequence is held in one row, 20 bytes a turn.
    """
    small, heads = _bursts(cut(distinct_paths(sequences)), container_paths)
    sorted_rows = small.repartition("head").sortWithinPartitions("head", "seq")
    swept = cut(sorted_rows.mapInArrow(_swept, _SWEPT))
    columns = [item.split()[0] for item in NODE.split(", ")]
    nodes = swept.select(*columns)
    tops = swept.filter(F.col("up").isNotNull()).select("up", "round", "n_leaves", "saved_tokens")
    for number in reversed(range(len(heads))):
        below = (
            tops.filter(F.col("round") == number + 1)
            .groupBy(F.col("up").alias("head"))
            .agg(
                F.count("*").alias("children"),
                F.sum("n_leaves").alias("leaves"),
                F.sum("saved_tokens").alias("saved"),
            )
        )
        whole = heads[number].join(below, "head")
        # the turns from each depth on; the root has no turn, so its list begins one deeper
        start = F.col("depth") - F.greatest(F.col("at"), F.lit(1)) + 1
        later = F.filter(F.col("bytes"), lambda size, i: i + 1 >= start)
        spared = F.aggregate(later, F.lit(0).cast("long"), lambda total, size: total + size)
        last = F.col("depth") == F.col("to")
        chain = cut(
            whole.withColumn("depth", F.explode(F.sequence("at", "to"))).select(
                F.col("low").alias("conv_id"),
                F.col("depth").cast("long").alias("depth"),
                F.when(F.col("depth") == F.col("at"), F.col("up_low")).otherwise(F.col("low")).alias("parent_conv_id"),
                F.col("n").alias("n_convs"),
                F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"),
                F.col("leaves").alias("n_leaves"),
                (F.col("saved") + (F.col("n") - 1) * spared).alias("saved_tokens"),
                F.when(last, F.col("ends")).otherwise(EMPTY_SHA256).alias("ends_sha256"),
                F.when(F.col("depth") == F.col("at"), F.col("up")).alias("up"),
                "round",
            )
        )
        nodes = nodes.unionByName(chain.select(*columns))
        tops = tops.unionByName(
            chain.filter(F.col("up").isNotNull()).select("up", "round", "n_leaves", "saved_tokens")
        )
    return nodes


def conversation_trie(
    conversations: DataFrame, container_paths: int = CONTAINER_PATHS, **columns: str
) -> DataFrame:
    """Trie of the rebuilt conversations of a table of turns, see `trie_nodes`.

    Null roles and texts are empty; turns without a number come first and repeated ones all count;
    rows without a conversation id are left out; other columns are not read; an empty table gives
    no node. `columns` are those of `turn_sequences`.
    """
    sequences = rebuilt_sequences(turn_sequences(conversations, **columns))
    return trie_nodes(sequences, container_paths)
