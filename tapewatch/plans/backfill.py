"""Corrections of past days: only the days that they touch are written again.

The layer is a table of typed events in one folder per day. A correction brings new rows for event
ids, which may lie on another day than the old ones, and ids to withdraw. Touched are the days of the
old rows and those of the new ones; all other days keep their files, byte for byte.

A run has a name. Its days are settled and its rows staged before anything is replaced, so a run that
died is run again under its name with the same result, and so is one that had finished.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.operators.first_wins import first_per_key
from tapewatch.plans.history import REPLACE_DAYS, update_history

DAY = "event_date"
_RUNS = "_backfill"


def write_days(typed_events: DataFrame, folder: str) -> None:
    """Writes the days that `typed_events` holds, in place of what these days held."""
    rows = typed_events.hint("rebalance", DAY)
    rows.write.mode("overwrite").options(**REPLACE_DAYS).partitionBy(DAY).parquet(folder)


def read_days(spark: SparkSession, folder: str, days: list[date] | None = None) -> DataFrame:
    """The layer, or some days of it: other days' folders are not opened."""
    rows = spark.read.parquet(folder)
    return rows if days is None else rows.filter(F.col(DAY).isin(days))


def _path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _exists(spark: SparkSession, text: str) -> bool:
    files, path = _path(spark, text)
    return files.exists(path)


def _write_once(rows: DataFrame, folder: str) -> DataFrame:
    """`rows` as `folder` has them; written unless an earlier attempt finished that."""
    spark = rows.sparkSession
    if not _exists(spark, f"{folder}/_SUCCESS"):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _without_empty_days(spark: SparkSession, folder: str, emptied: list[date]) -> None:
    for day in emptied:
        files, path = _path(spark, f"{folder}/{DAY}={day.isoformat()}")
        files.delete(path, True)


def backfill(
    corrections: DataFrame,
    layer_dir: str,
    run: str,
    withdrawn: DataFrame | None = None,
    history_dir: str | None = None,
) -> list[date]:
    """Puts corrections into the layer, and their days into the history; returns the days touched.

    `corrections` has the columns of the layer; of several rows of an id the first counts, by
    `first_wins.arrival_order`. An id that the layer does not have is added. `withdrawn` (event_id)
    are ids to remove; an id in both is corrected. Rows without an id or a day are left out. A day
    without rows afterwards loses its folder. Days go through the driver, one value per day.
    """
    spark = corrections.sparkSession
    layer = spark.read.parquet(layer_dir)
    usable = corrections.select(*layer.columns).filter(F.col("event_id").isNotNull() & F.col(DAY).isNotNull())
    given = first_per_key(usable, ["event_id"])
    parts = [given.select("event_id")] + ([withdrawn.select("event_id")] if withdrawn is not None else [])
    ids = reduce(DataFrame.union, parts).distinct()

    staged = f"{layer_dir}/{_RUNS}/{run}"
    touched = layer.join(ids, "event_id", "left_semi").select(DAY).union(given.select(DAY)).distinct()
    settled = _write_once(touched.coalesce(1), f"{staged}/days")
    days = sorted(row[0] for row in settled.collect())
    if not days:
        return []
    kept = read_days(spark, layer_dir, days).join(ids, "event_id", "left_anti").select(*layer.columns)
    rows = _write_once(kept.unionByName(given), f"{staged}/rows")
    filled = {row[0] for row in rows.select(DAY).distinct().collect()}
    emptied = [day for day in days if day not in filled]
    write_days(rows, layer_dir)
    _without_empty_days(spark, layer_dir, emptied)
    if history_dir is not None:
        update_history(rows, history_dir)
        _without_empty_days(spark, history_dir, emptied)
    return days
