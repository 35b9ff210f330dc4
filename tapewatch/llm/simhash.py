"""Near-duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints that differ in at most r bits (r even) have a common variant that differs from
each in at most r/2 bits. So every fingerprint emits all its variants within r/2 bits (2,081 for
r = 4), variants are shuffled, and fingerprints that meet are linked to the smallest one in
their place. Two that meet are within r bits by the triangle inequality, so a place needs no pairs:
its members are one class, and there are at most 2,081 different ones.

Before that, fingerprints that cannot have a link are set aside, by the same hashing on halves: of
r differing bits at most r/2 are in one of the two 32-bit halves, so the two fingerprints share a
variant of that half within r/4 bits, rounded up (66 variants for r = 4). A fingerprint without a
partner there at r bits or fewer on the whole has no link at all. This is a semi-join: a fingerprint
is emitted once per place however many partners it has. It spares nearly all of the 2,081 variants.

Equal fingerprints are merged before all this, so copies cost nothing, and every step after works on
distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewatch.llm.components import connected_components
from tapewatch.llm.support import cut, long_literals, pieces_of, release_tables, signed

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42

#: For each byte value, its eight bits in the eight bytes of a word, lowest bit first.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit `hashes` have each bit set."""
    total = np.zeros(64, dtype=np.int64)
    columns = hashes.view(np.uint8).reshape(-1, 8)
    for start in range(0, len(columns), 255):  # byte counters hold 255 at most
        part = _SPREAD[columns[start : start + 255]].sum(axis=0, dtype=np.uint64)
        total += part.view(np.uint8)
    return total


def text_fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash over the word shingles of `text`, repeats included.

    A-Z are lower-cased and words split at ASCII white space. A text of fewer words is one shingle; a
    text without words has fingerprint zero. A bit is set if more than half of the hashes have it.
    """
    counts, number, carry = np.zeros(64, dtype=np.int64), 0, []
    seen = 0
    for piece in pieces_of((text or "").encode().lower()):
        found = piece.split()
        seen += len(found)
        found = carry + found
        carry = found[max(0, len(found) - words + 1) :] if words > 1 else []
        if len(found) < words:
            continue
        line = b" ".join(found)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = [0, *(ends[: len(found) - words] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], HASH_SEED) for a, b in zip(starts, ends[words - 1 :].tolist())]
        counts += _set_bits(np.array(hashes, dtype=np.uint64))
        number += len(hashes)
    if not seen:
        return 0
    if not number:
        counts = _set_bits(np.array([xxhash.xxh64_intdigest(b" ".join(carry), HASH_SEED)], dtype=np.uint64))
        number = 1
    return int(np.packbits(counts * 2 > number, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """`text_fingerprint` as a BIGINT column."""

    @F.arrow_udf("long")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release_tables()
        for texts in batches:
            values = (signed(text_fingerprint(text.as_py(), words)) for text in texts)
            yield pa.array(values, pa.int64(), size=len(texts))

    return column(text)


def ball(bits: int, radius: int) -> list[int]:
    """Masks of at most `radius` set bits among the lowest `bits`."""
    return [
        sum(1 << bit for bit in chosen)
        for size in range(radius + 1)
        for chosen in combinations(range(bits), size)
    ]


def _with_partner(prints: DataFrame, max_bits: int) -> DataFrame:
    """The fingerprints `f` that have another one within `max_bits`."""
    masks = long_literals(ball(32, -(-(max_bits // 2) // 2)))
    low = F.lit(0xFFFFFFFF).cast("long")
    halves = prints.select(
        "f",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.shiftrightunsigned("f", 32).alias("bits")),
                F.struct(F.lit(1).alias("side"), F.col("f").bitwiseAND(low).alias("bits")),
            )
        ).alias("half"),
    )
    # side in bit 32, above the variant
    places = halves.select(
        "f",
        F.shiftleft(F.col("half.side").cast("long"), 32).bitwiseOR(F.col("half.bits")).alias("half"),
        F.explode(masks).alias("mask"),
    ).select("f", F.col("half").bitwiseXOR(F.col("mask")).alias("place"))
    other = places.select(F.col("f").alias("g"), F.col("place").alias("there"))
    near = F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= max_bits
    met = places.join(
        other, (F.col("place") == F.col("there")) & (F.col("f") != F.col("g")) & near, "left_semi"
    )
    return met.select("f").distinct()


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints `f` that join all within `max_bits` bits.

    Not all pairs: each place links its members to its smallest one.
    """
    if max_bits < 0 or max_bits % 2:
        raise ValueError("max_bits must be even: fingerprints meet half way")
    linked = cut(_with_partner(prints, max_bits))
    variants = linked.select("f", F.explode(long_literals(ball(64, max_bits // 2))).alias("mask")).select(
        "f", F.col("f").bitwiseXOR(F.col("mask")).alias("variant")
    )
    # A place holds at most as many fingerprints as the ball has masks, so its list is bounded.
    lowest = F.min("f").over(Window.partitionBy("variant"))
    return (
        variants.select("f", lowest.alias("low"))
        .filter(F.col("f") != F.col("low"))
        .select(F.col("low").alias("a"), F.col("f").alias("b"))
        .distinct()
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )


def simhash_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    Rows are linked if their fingerprints differ in at most `max_bits` bits; `component_id` is the
    smallest id reachable over links. Null and empty texts have fingerprint zero and are linked like
    any other. Rows without an id take part, but never name a component; one of such rows only has a
    null component_id. Repeated rows stay. An empty table gives no rows; other columns are not read.
    """
    rows = cut(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"), fingerprint(F.col(text_column), words).alias("f")
        )
    )
    prints = cut(rows.groupBy("f").agg(F.min("doc_id").alias("first")))
    components = connected_components(near_links(prints.select("f"), max_bits))
    labelled = prints.join(components, prints["f"] == components["node"], "left").select(
        "f", "first", F.coalesce("component", "f").alias("label")
    )
    smallest = labelled.groupBy(F.col("label").alias("of")).agg(F.min("first").alias("component_id"))
    named = labelled.join(smallest, F.col("label") == F.col("of")).select(
        F.col("f").alias("print"), "component_id"
    )
    return rows.join(named, F.col("f") == F.col("print")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
