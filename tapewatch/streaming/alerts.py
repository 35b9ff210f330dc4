"""Alerts that leave once, however often their events are delivered.

The stream keeps the ids of alerts until the watermark has passed their event time by `delay`; the
ids are part of the checkpoint, so a restart does not forget them. The watermark is the latest event
time seen less `delay`. A row is late if it is older than the watermark that the batch before began
with. A late alert cannot be told from a repeated one any more and does not leave here; the query's
progress counts it, and `late_alerts` finds it among the alerts that came in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapewatch.functions.activity import DEFAULT_THRESHOLDS, Thresholds
from tapewatch.functions.iso import iso_timestamp
from tapewatch.operators.first_wins import SOURCE_ORDER, first_per_key
from tapewatch.schema import ENRICHED_FIELDS
from tapewatch.sources.jsonl import enriched_text, parse_enriched, parse_events, strip_lines
from tapewatch.streaming.consumer import ALERT, route

DELAY = "1 hour"
#: What makes two alerts the same: the id, or the whole line of an event whose id is null.
IDENTITY = ["event_id", "line_digest"]
_BATCH = "batch_id"


def event_instant(event_timestamp: Column) -> Column:
    """The event's time as an instant, which a watermark needs; it does not depend on the session's zone."""
    clock = iso_timestamp(event_timestamp)
    return F.concat(clock.cast("string"), F.lit("Z")).try_cast("timestamp")


def alert_lines(lines: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Alerts among event lines, batch or stream: (event_id, line_digest, event_time, value)."""
    order = [SOURCE_ORDER] if SOURCE_ORDER in lines.columns else []
    routed = route(parse_events(strip_lines(lines)), thresholds).filter(F.col("route") == ALERT)
    return routed.select(
        "event_id",
        F.when(F.col("event_id").isNull(), F.sha2(F.col("value").cast("binary"), 256)).alias("line_digest"),
        event_instant(F.col("event_timestamp")).alias("event_time"),
        enriched_text().alias("value"),
        *order,
    )


def distinct_alerts(alerts: DataFrame) -> DataFrame:
    """The batch form: the first alert of each identity, by the order of the input if it is recorded."""
    order = [F.col(SOURCE_ORDER)] if SOURCE_ORDER in alerts.columns else [F.col("event_time"), F.col("value")]
    return first_per_key(alerts, IDENTITY, order).drop(SOURCE_ORDER)


def start_alerts(
    lines: DataFrame,
    output_dir: str,
    checkpoint_dir: str,
    *,
    delay: str = DELAY,
    poll_interval: str | None = None,
    thresholds: Thresholds = DEFAULT_THRESHOLDS,
) -> StreamingQuery:
    """Writes each alert of a stream of event lines once, to `output_dir/batch_id=N`.

    A batch that is retried replaces its folder. Repeats leave out what was sent before them within
    `delay` of event time. Without `poll_interval` the query handles what is there and stops.
    """
    alerts = alert_lines(lines, thresholds).withWatermark("event_time", delay)
    first = alerts.dropDuplicatesWithinWatermark(IDENTITY)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.select("value").write.mode("overwrite").text(f"{output_dir}/{_BATCH}={batch_id}")

    nothing = lines.sparkSession.createDataFrame([], f"value string, {_BATCH} string")
    nothing.write.mode("ignore").partitionBy(_BATCH).text(output_dir)
    writer = first.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    if poll_interval:
        return writer.trigger(processingTime=poll_interval).start()
    return writer.trigger(availableNow=True).start()


def _sent_lines(spark: SparkSession, output_dir: str) -> DataFrame:
    return spark.read.schema("value string").text(output_dir).select("value")


def read_alerts(spark: SparkSession, output_dir: str) -> DataFrame:
    """Alerts that have left, parsed."""
    return parse_enriched(_sent_lines(spark, output_dir)).select(*ENRICHED_FIELDS)


def late_alerts(alerts: DataFrame, spark: SparkSession, output_dir: str) -> DataFrame:
    """Of `alerts` (see `alert_lines`) the distinct ones that never left because they came too late."""
    sent = alert_lines(_sent_lines(spark, output_dir)).select("event_id", "line_digest")
    came = distinct_alerts(alerts)
    same = came["event_id"].eqNullSafe(sent["event_id"])
    # an alert without an id is known by its line, which enrichment has lengthened: it counts as sent
    return came.filter(F.col("event_id").isNotNull()).join(sent, same, "left_anti")


def dropped_as_late(query: StreamingQuery) -> int:
    """Rows that the query's batches in memory have dropped behind the watermark."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
