"""Quarantine rate by window of event time, and spikes in it.

Counts add up, so the stream needs no state: each micro-batch writes the counts of its own rows by
window to `batch_id=N`, and readers add them up. The result equals a batch query over the same
lines in any order of files, and after any restart, as a retried batch replaces its folder.

Late rows are never lost: they count for their own window when they come. The watermark only says
which windows readers may take as final: it is the latest event time of the batches before, less
`delay`. Counts that reach a window after the watermark passed its end are told by `late_counts`.
Lines without a readable time (malformed ones as well) count in the window null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapewatch.functions.activity import DEFAULT_THRESHOLDS, Thresholds
from tapewatch.sources.jsonl import parse_events, strip_lines
from tapewatch.streaming.alerts import event_instant
from tapewatch.streaming.consumer import ALERT, INVALID, route

BY = "source"
SECONDS = 3600
COUNTS = ["events", "invalid", "alerts"]
_BATCH = "batch_id"
_START = "start_second"


def window_start(seconds: Column) -> Column:
    """UTC wall clock of a second since 1970; it does not depend on the session's zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds)


def _counts(lines: DataFrame, by: str, seconds: int, thresholds: Thresholds) -> DataFrame:
    """Rows per window and key; `latest` is the last second seen. Combined before the shuffle."""
    routed = route(parse_events(strip_lines(lines)), thresholds)
    second = F.unix_seconds(event_instant(F.col("event_timestamp")))
    timed = routed.select(F.col(by).alias(by), "route", second.alias("second"))
    return timed.groupBy((F.col("second") - F.pmod("second", F.lit(seconds))).alias(_START), by).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("route") == INVALID).alias("invalid"),
        F.count_if(F.col("route") == ALERT).alias("alerts"),
        F.max("second").alias("latest"),
    )


def _rates(counts: DataFrame, by: str) -> DataFrame:
    """Counts added up, and invalid per million rows, cut to a whole number."""
    totals = counts.groupBy(_START, by).agg(*[F.sum(name).alias(name) for name in COUNTS])
    share = F.call_function("div", F.col("invalid").cast("decimal(20,0)") * 1_000_000, F.col("events"))
    start = window_start(F.col(_START)).alias("window_start")
    return totals.select(start, by, *COUNTS, share.cast("bigint").alias("invalid_per_million"))


def quarantine_rates(
    lines: DataFrame, by: str = BY, seconds: int = SECONDS, thresholds: Thresholds = DEFAULT_THRESHOLDS
) -> DataFrame:
    """The batch form: (window_start, by, events, invalid, alerts, invalid_per_million)."""
    return _rates(_counts(lines, by, seconds, thresholds), by)


def start_rates(
    lines: DataFrame,
    output_dir: str,
    checkpoint_dir: str,
    *,
    by: str = BY,
    seconds: int = SECONDS,
    poll_interval: str | None = None,
    thresholds: Thresholds = DEFAULT_THRESHOLDS,
) -> StreamingQuery:
    """Counts a stream of event lines. Without `poll_interval` it handles what is there and stops."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        counts = _counts(batch, by, seconds, thresholds)
        counts.coalesce(1).write.mode("overwrite").parquet(f"{output_dir}/{_BATCH}={batch_id}")

    writer = lines.select("value").writeStream.foreachBatch(write_batch)
    writer = writer.option("checkpointLocation", checkpoint_dir)
    if poll_interval:
        return writer.trigger(processingTime=poll_interval).start()
    return writer.trigger(availableNow=True).start()


def _written(spark: SparkSession, output_dir: str, by: str) -> DataFrame:
    layout = f"{_START} bigint, `{by}` string, events bigint, invalid bigint, alerts bigint, latest bigint, {_BATCH} bigint"
    return spark.read.schema(layout).parquet(output_dir)


def read_rates(spark: SparkSession, output_dir: str, by: str = BY) -> DataFrame:
    """Rates of everything that has come so far, open windows included."""
    return _rates(_written(spark, output_dir, by), by)


def _watermarks(counts: DataFrame, delay_seconds: int) -> DataFrame:
    """One row per batch: the watermark that it began with, null for the first.

    One task sorts one row per batch, which a year of batches a second keeps below 32 million.
    """
    latest = counts.groupBy(_BATCH).agg(F.max("latest").alias("latest"))
    before = Window.orderBy(_BATCH).rowsBetween(Window.unboundedPreceding, -1)
    return latest.select(_BATCH, (F.max("latest").over(before) - delay_seconds).alias("watermark"))


def final_rates(
    spark: SparkSession, output_dir: str, delay_seconds: int, by: str = BY, seconds: int = SECONDS
) -> DataFrame:
    """Rates of the windows that end at or before the watermark of all that has come."""
    counts = _written(spark, output_dir, by)
    mark = counts.agg((F.max("latest") - delay_seconds).alias("watermark"))
    ended = counts.join(F.broadcast(mark), F.col(_START) + seconds <= F.col("watermark"))  # one row
    return _rates(ended.select(_START, by, *COUNTS), by)


def late_counts(
    spark: SparkSession, output_dir: str, delay_seconds: int, by: str = BY, seconds: int = SECONDS
) -> DataFrame:
    """Counts that came to a window after the watermark had passed its end: they changed final rates."""
    counts = _written(spark, output_dir, by)
    marked = counts.join(_watermarks(counts, delay_seconds), _BATCH)
    late = marked.filter(F.col(_START) + seconds <= F.col("watermark"))
    totals = late.groupBy(_START, by).agg(*[F.sum(name).alias(name) for name in COUNTS])
    return totals.select(window_start(F.col(_START)).alias("window_start"), by, *COUNTS)


def spikes(
    rates: DataFrame,
    by: str = BY,
    before_seconds: int = 24 * SECONDS,
    factor: int = 3,
    min_invalid: int = 10,
) -> DataFrame:
    """Windows whose quarantine rate is `factor` times that of the key's windows before, or more.

    Compared are the windows that begin within `before_seconds`; at least `min_invalid` rows must be
    invalid, and a window with nothing before it is no spike. Fractions are compared by exact
    products. Adds base_events and base_invalid. A key has one row per window, so the windows of
    one key are bounded by time.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    second = F.timestamp_diff("SECOND", epoch, F.col("window_start"))
    before = Window.partitionBy(by).orderBy(second).rangeBetween(-before_seconds, -1)
    based = rates.filter(F.col("window_start").isNotNull()).withColumns(
        {
            "base_events": F.sum("events").over(before),
            "base_invalid": F.sum("invalid").over(before),
        }
    )

    def wide(name: str) -> Column:
        return F.col(name).cast("decimal(15,0)")

    beyond = wide("invalid") * wide("base_events") >= wide("base_invalid") * wide("events") * factor
    return based.filter((F.col("invalid") >= min_invalid) & (F.col("base_events") > 0) & beyond)
