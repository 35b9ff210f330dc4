"""Star schema of Parquet tables, loaded insert-if-absent.

A load writes folders of its own and then commits them to a log, in one step for all tables; readers
follow the log only. A load that died has left nothing that anyone reads, and can be run again; one
that has been committed is not run twice under its id. Loads may run at the same time: the second to
commit takes out the keys that the first has inserted meanwhile and commits what is left, so each key
is held once. The four tables are merged independently, each by its own key, so a replayed event
with other flags adds flag rows although its event row is kept.

Beside the rows of the fact tables a load writes their keys, bucketed, which later loads look up
instead of the rows; and a list of its files with the times they hold, by which reads of a time span
open those files only.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from contextlib import ExitStack
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewatch.operators.enrich import activity_rows, with_types
from tapewatch.operators.first_wins import SOURCE_ORDER, contract_rows, first_per_key
from tapewatch.plans.commits import CommitLog, Load, State
from tapewatch.schema import (
    WAREHOUSE_AUDIT,
    WAREHOUSE_COLUMNS,
    WAREHOUSE_KEYS,
    WAREHOUSE_NULLABLE,
    warehouse_schema,
)
from tapewatch.sources.key_index import bucketed_keys, unheld, without_held, write_bucketed
from tapewatch.sources.tables import counted

TABLES = list(WAREHOUSE_COLUMNS)
REJECTS = "load_rejects"
REJECT_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
        T.StructField("record", T.StringType()),
        T.StructField("load_id", T.StringType()),
    ]
)
LOAD_ID = "load_id"
KEYS, FILES = "_keys", "_files"
FILES_SCHEMA = "name string, first timestamp_ntz, last timestamp_ntz, rows bigint"

#: Least buckets of the keys of a new warehouse; its first load may ask for more.
KEY_BUCKETS = 16
#: Rows that a task sorts, about 0.1 GB of events. A batch of more is dealt out by its number of rows.
TASK_ROWS = 200_000

# Tables whose files are clustered by time; the others are small and bucketed by key themselves.
TIME = "event_timestamp"
TIMED = ["fact_options_event", "fact_unusual_activity"]


@dataclass(frozen=True)
class Warehouse:
    """Location of the tables; each frame is a lazy scan of what was committed when it was made."""

    spark: SparkSession
    root: str

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.root)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def folder(self, table: str, load_id: str, attempt: str) -> str:
        return f"{self.path(table)}/{LOAD_ID}={load_id}/attempt={attempt}"

    def side_folder(self, kind: str, table: str, attempt: str) -> str:
        """Where the keys or the file list of a load are."""
        return f"{self.root.rstrip('/')}/{kind}/{table}/{attempt}"

    def folders(self, table: str, loads: Iterable[Load]) -> list[str]:
        """Folders of the loads that added rows to a table."""
        return [self.folder(table, load.load_id, load.attempts[table]) for load in loads if load.rows[table]]

    def schema(self, table: str) -> T.StructType:
        return REJECT_SCHEMA if table == REJECTS else warehouse_schema(table)

    def _read(self, table: str, paths: list[str]) -> DataFrame:
        schema = self.schema(table)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths).select(*schema.names)

    def stored(self, table: str) -> DataFrame:
        """All stored columns, audit columns and `load_id` included."""
        return self._read(table, self.folders(table, self.log.state().loads.values()))

    def table(self, table: str) -> DataFrame:
        """Natural columns of a table."""
        return self.stored(table).select(*WAREHOUSE_COLUMNS[table].names)

    def tables(self) -> dict[str, DataFrame]:
        return {table: self.table(table) for table in TABLES}

    def files_between(self, table: str, start: datetime, end: datetime) -> list[str]:
        """Files that hold rows from `start` to before `end`, by the lists that the loads left."""
        loads = [load for load in self.log.state().loads.values() if load.rows[table]]
        if not loads:
            return []
        lists = [self.side_folder(FILES, table, load.attempts[table]) for load in loads]
        parts = [
            self.spark.read.schema(FILES_SCHEMA).parquet(path).withColumn("folder", F.lit(folder))
            for path, folder in zip(lists, self.folders(table, loads))
        ]
        listed = reduce(DataFrame.unionByName, parts)
        first, last = (F.lit(time).cast("timestamp_ntz") for time in (start, end))
        within = listed.filter((F.col("last") >= first) & (F.col("first") < last))
        return [f"{row['folder']}/{row['name']}" for row in within.select("folder", "name").collect()]

    def between(self, table: str, start: datetime, end: datetime) -> DataFrame:
        """Natural columns of the rows of a fact table from `start` to before `end` (UTC)."""
        first, last = (F.lit(time).cast("timestamp_ntz") for time in (start, end))
        rows = self._read(table, self.files_between(table, start, end))
        within = rows.filter((F.col(TIME) >= first) & (F.col(TIME) < last))
        return within.select(*WAREHOUSE_COLUMNS[table].names)

    def create(self, reset: bool = False, key_buckets: int = KEY_BUCKETS) -> State:
        """The state of the log, begun if there is none; `reset` empties all tables."""
        while True:
            state = self.log.state()
            if state.version < 0:
                self.log.append(state, buckets=key_buckets)
            elif not reset or self.log.append(state, reset=True):
                return self.log.state() if reset else state

    def remove_leftovers(self, older_than_hours: float = 24) -> list[str]:
        """Removes folders of loads that are not in the log, if not changed for some hours.

        They are from loads that died, lost a race or were reset. The age must exceed the longest load.
        """
        log, listed = self.log, set()
        for load in log.state().loads.values():
            listed |= set(load.attempts.values())
        patterns = [f"{self.path(table)}/{LOAD_ID}=*/attempt=*" for table in [*TABLES, REJECTS]]
        patterns += [f"{self.root.rstrip('/')}/{kind}/*/*" for kind in (KEYS, FILES)]
        return log.remove(patterns, lambda name: name.removeprefix("attempt=") not in listed, older_than_hours)


def _fits(table: str) -> dict[str, Column]:
    """Column -> whether its value can be stored in the table."""
    checks = {}
    for field in WAREHOUSE_COLUMNS[table].fields:
        source = F.col(field.name)
        stored = source.try_cast(field.dataType)
        if field.name in WAREHOUSE_NULLABLE[table]:
            checks[field.name] = source.isNull() | stored.isNotNull()
        else:
            checks[field.name] = stored.isNotNull()
    return checks


def _storable(df: DataFrame, table: str) -> DataFrame:
    checks = _fits(table).values()
    return df.filter(reduce(lambda left, right: left & right, checks))


def table_input(typed: DataFrame, table: str) -> DataFrame:
    """Rows of a batch for one table, before keys are resolved."""
    if table == "dim_symbol":
        return typed.select("symbol")
    if table == "dim_option_contract":
        return contract_rows(typed)
    order = [SOURCE_ORDER] if SOURCE_ORDER in typed.columns else []
    if table == "fact_unusual_activity":
        return activity_rows(typed, *order)
    return typed.select(*WAREHOUSE_COLUMNS[table].names, *order)


def table_delta(typed: DataFrame, held: DataFrame | None, table: str, buckets: int = KEY_BUCKETS) -> DataFrame:
    """Rows a load would insert: stored types, first row per key, keys not in `held`."""
    keys = WAREHOUSE_KEYS[table]
    arrived = _storable(table_input(typed, table), table)
    first = arrived.distinct() if arrived.columns == keys else first_per_key(arrived, keys)
    return unheld(first, held, keys, buckets).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in WAREHOUSE_COLUMNS[table]]
    )


def parts_of(rows: int) -> int:
    """Tasks, or buckets of keys, of about `TASK_ROWS` rows."""
    return max(KEY_BUCKETS, -(-rows // TASK_ROWS))


def large_delta(typed: DataFrame, held: DataFrame | None, table: str, parts: int) -> DataFrame:
    """As `table_delta`, for a batch of many rows into a table whose keys are near unique.

    Rows move once: they are dealt into the buckets of `held`, whatever their number of copies, joined
    there and then cut to the first per key. Without `held` they are dealt into `parts`.
    """
    keys = WAREHOUSE_KEYS[table]
    dealt = _storable(table_input(typed, table), table).repartition(parts, *keys)
    if held is not None:
        dealt = without_held(dealt, held, keys)
    return first_per_key(dealt, keys).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in WAREHOUSE_COLUMNS[table]]
    )


def _row_id(keys: list[str]) -> Column:
    """A 128-bit id of a row's key."""
    first, *rest = [F.col(key) for key in keys]
    return F.md5(F.concat(F.octet_length(first).cast("string"), F.lit(":"), first, *rest))


def _with_audit(delta: DataFrame, table: str) -> DataFrame:
    id_column, time_column = WAREHOUSE_AUDIT[table]
    columns: list[Column] = [F.col(name) for name in delta.columns]
    if id_column:
        columns.insert(0, _row_id(WAREHOUSE_KEYS[table]).alias(id_column))
    return delta.select(*columns, F.localtimestamp().alias(time_column))


def rejected_rows(typed: DataFrame) -> DataFrame:
    """Events a fact or dimension cannot hold: a null in a required column or an overflow.

    The check of `fact_options_event` covers every column of the dimensions as well.
    """
    table = "fact_options_event"
    checks = _fits(table)
    slots = [
        F.when(~fits, f"{name} does not fit {table}").otherwise("")
        for name, fits in checks.items()
    ]
    reasons = F.array_remove(F.array(*slots), "")
    record = F.to_json(F.struct(*WAREHOUSE_COLUMNS[table].names))
    return typed.filter(~reduce(lambda left, right: left & right, checks.values())).select(
        F.lit(table).alias("table"),
        "event_id",
        reasons.alias("reasons"),
        record.alias("record"),
    )


def _write(
    warehouse: Warehouse, table: str, rows: DataFrame, load_id: str, buckets: int, expected: int = 0
) -> tuple[str, int]:
    """Writes rows of a load with their keys and file list; returns the attempt's name and their number.

    Where more than `TASK_ROWS` are `expected`, ranges of time are counted by them and not by Spark,
    which measures compressed bytes: a task would sort several times as many.
    """
    spark, keys = warehouse.spark, WAREHOUSE_KEYS[table]
    attempt = uuid.uuid4().hex
    folder = warehouse.folder(table, load_id, attempt)
    if table not in TIMED:
        out, observation = counted(rows)
        write_bucketed(out, folder, keys, buckets)
        return attempt, observation.get["rows"]
    ranges = [parts_of(expected)] if expected > TASK_ROWS else []
    out, observation = counted(rows.repartitionByRange(*ranges, TIME).sortWithinPartitions(TIME, "symbol"))
    out.write.parquet(folder)
    number = observation.get["rows"]
    if number:
        written = spark.read.schema(warehouse.schema(table)).parquet(folder)
        write_bucketed(written.select(*keys), warehouse.side_folder(KEYS, table, attempt), keys, buckets)
        files = written.groupBy(F.col("_metadata.file_name").alias("name")).agg(
            F.min(TIME).alias("first"), F.max(TIME).alias("last"), F.count("*").alias("rows")
        )
        files.coalesce(1).write.parquet(warehouse.side_folder(FILES, table, attempt))
    return attempt, number


def _held(stack: ExitStack, warehouse: Warehouse, table: str, loads: Iterable[Load], buckets: int) -> DataFrame | None:
    """Keys of a table that `loads` inserted, until `stack` is closed."""
    loads = [load for load in loads if load.rows[table]]
    if table in TIMED:
        folders = [warehouse.side_folder(KEYS, table, load.attempts[table]) for load in loads]
    else:
        folders = warehouse.folders(table, loads)
    types = {field.name: field.dataType.simpleString() for field in WAREHOUSE_COLUMNS[table]}
    return stack.enter_context(bucketed_keys(warehouse.spark, folders, types, WAREHOUSE_KEYS[table], buckets))


def _without(warehouse: Warehouse, mine: Load, others: list[Load], buckets: int) -> Load:
    """`mine` without the keys that loads committed meanwhile have inserted; tables without any stay."""
    attempts, rows = dict(mine.attempts), dict(mine.rows)
    for table in TABLES:
        with ExitStack() as stack:
            held = _held(stack, warehouse, table, others, buckets)
            own = _held(stack, warehouse, table, [mine], buckets)
            if held is None or own is None or own.join(held, WAREHOUSE_KEYS[table], "left_semi").isEmpty():
                continue
            schema = warehouse.schema(table)
            written = warehouse.spark.read.schema(schema).parquet(warehouse.folders(table, [mine])[0]).drop(LOAD_ID)
            keys, many = WAREHOUSE_KEYS[table], mine.rows[table]
            if many > TASK_ROWS:
                left = without_held(written.repartition(buckets, *keys), held, keys)
            else:
                left = unheld(written, held, keys, buckets)
            left = left.select(*written.columns)
            attempts[table], rows[table] = _write(warehouse, table, left, mine.load_id, buckets, many)
    return Load(mine.load_id, attempts, rows)


def _prepared(warehouse: Warehouse, typed: DataFrame, load_id: str, state: State) -> Load:
    """A load against `state`, written but not committed."""
    attempts, rows, arrived = {}, {}, typed.count()
    for table in TABLES:
        with ExitStack() as stack:
            held = _held(stack, warehouse, table, state.loads.values(), state.buckets)
            if table in TIMED and arrived > TASK_ROWS:
                delta = large_delta(typed, held, table, parts_of(arrived) if held is None else state.buckets)
            else:
                delta = table_delta(typed, held, table, state.buckets)
            delta = _with_audit(delta, table)
            attempts[table], rows[table] = _write(warehouse, table, delta, load_id, state.buckets, arrived)
    attempts[REJECTS] = uuid.uuid4().hex
    rejected, observation = counted(rejected_rows(typed))
    rejected.write.parquet(warehouse.folder(REJECTS, load_id, attempts[REJECTS]))
    rows[REJECTS] = observation.get["rows"]
    return Load(load_id, attempts, rows)


@dataclass(frozen=True)
class PreparedLoad:
    """A load that is written but that nobody sees yet."""

    warehouse: Warehouse
    typed: DataFrame
    state: State
    load: Load


def prepare_load(
    enriched: DataFrame, root: str, load_id: str, reset: bool = False, key_buckets: int | None = None
) -> PreparedLoad | dict[str, int]:
    """Writes a load against the tables as they are now; the rows it inserted if it is committed already."""
    if not re.fullmatch(r"[\w.\-]+", load_id):
        raise ValueError("a load id has letters, digits, points, hyphens and underscores")
    warehouse = Warehouse(enriched.sparkSession, root)
    if key_buckets is None:
        key_buckets = KEY_BUCKETS if warehouse.log.state().buckets else parts_of(enriched.count())
    state = warehouse.create(reset, key_buckets)
    if load_id in state.loads:
        return _inserted(state.loads[load_id])
    typed = with_types(enriched)
    return PreparedLoad(warehouse, typed, state, _prepared(warehouse, typed, load_id, state))


def _inserted(load: Load) -> dict[str, int]:
    return {table: load.rows[table] for table in TABLES}


def commit_load(prepared: PreparedLoad) -> dict[str, int]:
    """Makes a written load visible, without what others have inserted since; the rows inserted."""
    warehouse, state, mine = prepared.warehouse, prepared.state, prepared.load
    while not warehouse.log.append(state, load=vars(mine)):
        newer = warehouse.log.state()
        if mine.load_id in newer.loads:
            return _inserted(newer.loads[mine.load_id])
        if newer.epoch != state.epoch:
            # the tables were emptied: what was left out may be missing now
            mine = _prepared(warehouse, prepared.typed, mine.load_id, newer)
        else:
            mine = _without(warehouse, mine, newer.since(state), state.buckets)
        state = newer
    return _inserted(mine)


def load_warehouse(
    enriched: DataFrame,
    root: str,
    reset: bool = False,
    load_id: str | None = None,
    key_buckets: int | None = None,
) -> dict[str, int]:
    """Merge enriched events into the four tables; returns the rows inserted into each.

    `load_id` names a delivery: once committed it is not loaded again, and the rows inserted then are
    returned. The batch is counted, then read once per table with only that table's columns, so pass a
    Parquet-backed frame when it is large. Events that do not fit are written to `load_rejects`.
    `key_buckets` is that of a new warehouse, by default for `TASK_ROWS` of this batch in each; an
    existing one keeps its own.
    """
    prepared = prepare_load(enriched, root, load_id or uuid.uuid4().hex, reset, key_buckets)
    return commit_load(prepared) if isinstance(prepared, PreparedLoad) else prepared
