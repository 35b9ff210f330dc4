"""Batch folders of a stream packed into few large files, while the stream and its readers go on.

The consumer writes a folder per micro-batch, so a stream that runs for a year leaves millions of small
files. `compact` copies finished batches into a generation, a folder that holds a range of batches, and
commits it to a log; readers take the generations of the log and the batches after the last of them, so
they see every row once at any moment. Generations that are not at least twice as large as what follows
them are packed with it. Sizes therefore fall by half from one to the next: there are few, and a row is
copied again only when its generation at least grows by half. One of `settled_bytes` stays as it is.

A batch is finished when the next one has begun; the last folder may be a retry's and is never taken.
Nothing is replaced in place. What the log no longer needs is removed later by `remove_compacted`.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapewatch.plans.batch import REPLACE_ALL, ROUTE, read_route
from tapewatch.plans.commits import CommitLog, State

FOLDER = "_generations"
_BATCH = "batch_id="
_ROUTE = f"{ROUTE}="


@dataclass(frozen=True)
class Part:
    """Rows of the batches `first` to `last`: a generation, or one batch folder."""

    first: int
    last: int
    folder: str
    bytes: int = 0


class _Output:
    """The folders of a stream's output."""

    def __init__(self, spark: SparkSession, output_dir: str):
        self.spark = spark
        self.root = output_dir.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/{FOLDER}")
        self._new_path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._new_path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def folders(self, below: str, prefix: str = "") -> list[str]:
        """Names of the folders below one that begin with `prefix`."""
        found = self._files.globStatus(self._new_path(f"{below}/{prefix}*")) or []
        return [status.getPath().getName() for status in found if status.isDirectory()]

    def bytes_of(self, folder: str) -> int:
        return self._files.getContentSummary(self._new_path(folder)).getLength()

    def remove(self, folder: str) -> None:
        self._files.delete(self._new_path(folder), True)

    def batches(self, after: int) -> list[Part]:
        """Batch folders with a number above `after`, in order."""
        numbers = [name.removeprefix(_BATCH) for name in self.folders(self.root, _BATCH)]
        later = sorted(int(number) for number in numbers if number.isdigit() and int(number) > after)
        return [Part(number, number, f"{self.root}/{_BATCH}{number}") for number in later]

    def routes(self, parts: list[Part]) -> dict[str, list[str]]:
        """The folders of each route that the parts have."""
        found: dict[str, list[str]] = {}
        for part in parts:
            for name in self.folders(part.folder, _ROUTE):
                found.setdefault(name.removeprefix(_ROUTE), []).append(f"{part.folder}/{name}")
        return found

    def generations(self, state: State) -> list[Part]:
        """What the log lists, in the order of batches."""
        listed = [
            Part(load.rows["first"], load.rows["last"], f"{self.root}/{FOLDER}/{load.load_id}", load.rows["bytes"])
            for load in state.loads.values()
        ]
        return sorted(listed, key=lambda part: part.first)


def _last(generations: list[Part]) -> int:
    """The last batch that a generation holds."""
    return max((part.last for part in generations), default=-1)


def compacted_until(spark: SparkSession, output_dir: str) -> int:
    """The last batch that a committed generation holds; -1 if there is none."""
    output = _Output(spark, output_dir)
    return _last(output.generations(output.log.state()))


def outgrown(generations: list[Part], fresh_bytes: int, settled_bytes: int) -> list[Part]:
    """The latest generations that are to be packed with `fresh_bytes` of batches that follow them."""
    size, taken = fresh_bytes, []
    for part in reversed(generations):
        if part.bytes >= settled_bytes or part.bytes > 2 * size:
            break
        taken.append(part)
        size += part.bytes
    return taken[::-1]


def compact(
    spark: SparkSession,
    output_dir: str,
    *,
    min_batches: int = 2,
    file_bytes: int = 256 << 20,
    settled_bytes: int = 64 << 30,
) -> Part | None:
    """Packs the finished batches that no generation holds; returns the new generation.

    None if fewer than `min_batches` are there, or if another run committed first: its folder is then
    not listed and `remove_compacted` takes it. Each route is copied by tasks of about `file_bytes`
    without a shuffle. Besides its full files an output has one file per route for each generation,
    whose number is below log2(settled_bytes) + total bytes / settled_bytes, and those of open batches.
    """
    output = _Output(spark, output_dir)
    state = output.log.state()
    listed = output.generations(state)
    fresh = output.batches(after=_last(listed))[:-1]
    if len(fresh) < max(min_batches, 1):
        return None
    packed = outgrown(listed, sum(output.bytes_of(part.folder) for part in fresh), settled_bytes)
    parts = packed + fresh
    name = f"{parts[0].first}-{parts[-1].last}-{uuid.uuid4().hex}"
    folder = f"{output.root}/{FOLDER}/{name}"

    size = rows = 0
    for route, folders in sorted(output.routes(parts).items()):
        held = sum(output.bytes_of(one) for one in folders)
        observed = Observation()
        lines = spark.read.schema("value string").text(folders)
        lines = lines.coalesce(max(1, -(-held // file_bytes))).observe(observed, F.count(F.lit(1)).alias("rows"))
        lines.write.mode("overwrite").options(**REPLACE_ALL).text(f"{folder}/{_ROUTE}{route}")
        size, rows = size + held, rows + observed.get["rows"]

    entry = {"first": parts[0].first, "last": parts[-1].last, "bytes": size, "rows": rows, "ms": _now_ms()}
    load = {"load_id": name, "attempts": {}, "rows": entry}
    if not output.log.append(state, load=load, drop=[part.folder.rsplit("/", 1)[1] for part in packed]):
        return None
    return Part(entry["first"], entry["last"], folder, size)


def _now_ms() -> int:
    return int(time.time() * 1000)


def read_output(spark: SparkSession, output_dir: str, route: str) -> DataFrame:
    """Lines (`value`) of a route: those of the generations and those of batches after them."""
    output = _Output(spark, output_dir)
    listed = output.generations(output.log.state())
    if not listed:
        return read_route(spark, output_dir, route)
    folders = output.routes(listed + output.batches(after=_last(listed))).get(route)
    if not folders:
        return spark.createDataFrame([], "value string")
    return spark.read.schema("value string").text(folders)


def remove_compacted(spark: SparkSession, output_dir: str, older_than_hours: float) -> list[str]:
    """Removes batches and generations that a listed generation has held for that long.

    The time counts from the commit of the generation that holds them, not from their own writing, so a
    reader that began before it keeps its files for `older_than_hours`. A run that died leaves a
    generation that is not listed; it goes once a listed one holds its batches.
    """
    output = _Output(spark, output_dir)
    state = output.log.state()
    before = _now_ms() - older_than_hours * 3600 * 1000
    settled = [load.rows for load in state.loads.values() if load.rows["ms"] < before]

    def is_held(first: int, last: int) -> bool:
        return any(rows["first"] <= first and last <= rows["last"] for rows in settled)

    removed = [part.folder for part in output.batches(after=-1) if is_held(part.first, part.last)]
    for name in output.folders(f"{output.root}/{FOLDER}"):
        first, _, rest = name.partition("-")
        last = rest.partition("-")[0]
        if name not in state.loads and first.isdigit() and last.isdigit() and is_held(int(first), int(last)):
            removed.append(f"{output.root}/{FOLDER}/{name}")
    for folder in removed:
        output.remove(folder)
    return removed
