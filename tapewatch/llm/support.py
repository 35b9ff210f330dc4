"""Shared folder, lineage cuts and small column helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from itertools import islice
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that occur more often than all but this many others are treated as hot. Of N rows, a key
#: beyond these has at most N / HOT_KEYS of them.
HOT_KEYS = 1024

#: Rows of whole texts that go to a Python worker at a time.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in `spark.checkpoint.dir`.

    Only a session on the driver's own threads may go without it; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder, so that its lineage ends there and any executor may go."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def with_group(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """`rows`, each with the row of `groups` that has its `keys`; `size` counts the rows of a group.

    `groups` has one row per key, keys hold no nulls, and no other column names are shared. The
    `HOT_KEYS` largest groups are broadcast, so rows of a hot group stay where they are; of N rows at
    most N / HOT_KEYS of any other group meet in one task. Both are read more than once: they should
    be tables that were cut.
    """
    hot = F.broadcast(
        groups.filter(F.col(size) > 1).orderBy(F.desc(size), *keys).limit(HOT_KEYS)
    )
    columns = [*rows.columns, *[name for name in groups.columns if name not in keys]]
    here = rows.join(hot, keys).select(*columns)
    others = rows.join(hot.select(*keys), keys, "left_anti")
    return here.unionByName(others.join(groups, keys).select(*columns))


def unused(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def long_literals(values) -> Column:
    """An array constant of 64-bit integers; unsigned ones as `signed` has them."""
    return F.expr("array(" + ", ".join(_long(signed(int(value))) for value in values) + ")")


def _long(value: int) -> str:
    return f"{value}L" if value > -(2**63) else "(-9223372036854775807L - 1L)"


def signed(value: int) -> int:
    """An unsigned 64-bit integer as Spark's BIGINT holds it."""
    return value - 2**64 if value >= 2**63 else value


def slices(batch: pa.RecordBatch, column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of `batch` in order, about `size` bytes of text or binary `column` at a time, one row at least.

    What a worker makes of a slice is handed on before it takes the next one.
    """
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for at, length in enumerate(lengths):
        if total and total + length > size:
            yield batch.slice(start, at - start)
            start, total = at, 0
        total += length
    if start < batch.num_rows:
        yield batch.slice(start)


def small_batches(spark: SparkSession) -> None:
    """Hands whole texts to Python workers `BATCH_ROWS` at a time, unless the session has a size of its own.

    A batch is held several times over, on both sides of the pipe. The size is a setting of the
    session and changes no result.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


_kept: list[tuple[Any, Any]] = []


def kept_in_worker(key: Any, build: Callable[[], Any]) -> Any:
    """`build()`, kept by this Python worker for its later tasks until other tables are asked for.

    A worker serves one stage after another: what an earlier one kept is given back first.
    """
    if not _kept or _kept[0][0] != key:
        release_tables()
        _kept.append((key, build()))
    return _kept[0][1]


def release_tables() -> None:
    """Gives back what this worker keeps; for stages that keep nothing themselves."""
    _kept.clear()


def trimmed(memory: dict, limit: int) -> None:
    """Forgets the later half of a memory over its limit: frequent words come early, rare ones late."""
    if len(memory) > limit:
        kept = list(islice(memory.items(), limit // 2))
        memory.clear()
        memory.update(kept)


def pieces_of(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """`data` in pieces of about `size` bytes, cut at ASCII white space so that no word is split.

    Bounds what a word list of one very long text can hold at a time.
    """
    start, total = 0, len(data)
    while total - start > size:
        end = start + size
        while end < total and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]
