"""Stream of event lines to alerts and quarantine.

Each micro-batch is written in one pass to `<output>/batch_id=N/route=...`. A batch that is
retried after a failure replaces its own folder, so with the checkpoint every event leaves
exactly once, and any reader of the folders sees no leftovers. `streaming.compaction` packs finished
batches into larger files; the readers here take them from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapewatch.functions.activity import DEFAULT_THRESHOLDS, Thresholds, is_unusual
from tapewatch.functions.text import processing_summary
from tapewatch.plans.batch import REPLACE_ALL, ROUTE, classify, unsorted_partition_writes
from tapewatch.schema import ENRICHED_FIELDS
from tapewatch.sources.jsonl import (
    enriched_text,
    parse_enriched,
    parse_events,
    quarantine_text,
    strip_lines,
)
from tapewatch.streaming.compaction import compacted_until, read_output

ALERT = "alert"
INVALID = "invalid"
NORMAL = "normal"
LOG = "log"


def route(events: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Classified events with `route`: invalid, alert (score above 0) or normal (dropped later)."""
    target = (
        F.when(~F.col("is_valid"), INVALID).when(is_unusual(), ALERT).otherwise(NORMAL)
    )
    return classify(events, thresholds).withColumn(ROUTE, target)


def status_line() -> F.Column:
    """Log line of a routed event."""
    return processing_summary(
        F.col("is_valid"),
        F.coalesce(F.col("unusual_activity_score"), F.lit(0)),
        F.coalesce(F.col("unusual_activity_flags"), F.array().cast("array<string>")),
    )


def output_lines(routed: DataFrame, log: bool = False) -> DataFrame:
    """(route, value) lines to write: alerts, quarantined events and, if asked, the log."""
    text = (
        F.when(F.col(ROUTE) == ALERT, enriched_text())
        .when(F.col(ROUTE) == INVALID, quarantine_text())
    )
    if not log:
        kept = routed.filter(F.col(ROUTE) != NORMAL)
        return kept.select(ROUTE, text.alias("value"))
    pair = F.struct(F.col(ROUTE).alias(ROUTE), text.alias("value"))
    log_pair = F.struct(F.lit(LOG).alias(ROUTE), status_line().alias("value"))
    return routed.select(F.inline(F.array(pair, log_pair))).filter(F.col("value").isNotNull())


def consume_batch(lines: DataFrame) -> DataFrame:
    """Routed events of a bounded input."""
    return route(parse_events(strip_lines(lines)))


def read_stream(
    spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Lines (`value`) of a growing directory of JSON-lines files.

    New events must arrive as new files, moved into place whole: bytes appended to a file
    already read are not seen. `options` go to the file source, e.g. `cleanSource`.
    """
    reader = spark.readStream.format("text").options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(input_dir)


def consume(
    lines: DataFrame,
    output_dir: str,
    checkpoint_dir: str,
    *,
    poll_interval: str | None = None,
    log: bool = False,
    thresholds: Thresholds = DEFAULT_THRESHOLDS,
) -> StreamingQuery:
    """Route a stream that has a `value` column, from files or any other source.

    Without `poll_interval` the query handles what is there and stops. A batch whose number is already
    in a compacted generation ends the query: the checkpoint is not the one that the output belongs to.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= compacted_until(batch.sparkSession, output_dir):
            raise ValueError(f"batch {batch_id} of {output_dir} is compacted; a new checkpoint needs a new output")
        out = output_lines(route(parse_events(batch), thresholds), log)
        with unsorted_partition_writes(batch.sparkSession):
            folder = f"{output_dir}/batch_id={batch_id}"
            out.write.mode("overwrite").partitionBy(ROUTE).options(**REPLACE_ALL).text(folder)

    # the folder exists from the start, so that it can be read before the first batch wrote to it
    nothing = lines.sparkSession.createDataFrame([], f"value string, batch_id string, {ROUTE} string")
    nothing.write.mode("ignore").partitionBy("batch_id", ROUTE).text(output_dir)

    writer = strip_lines(lines.select("value")).writeStream.foreachBatch(write_batch)
    writer = writer.option("checkpointLocation", checkpoint_dir)
    if poll_interval:
        return writer.trigger(processingTime=poll_interval).start()
    return writer.trigger(availableNow=True).start()


def start_consumer(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    checkpoint_dir: str,
    *,
    max_files_per_trigger: int | None = None,
    poll_interval: str | None = None,
    log: bool = False,
    thresholds: Thresholds = DEFAULT_THRESHOLDS,
) -> StreamingQuery:
    """Follow a directory of JSON-lines files, see `read_stream` and `consume`."""
    return consume(
        read_stream(spark, input_dir, max_files_per_trigger),
        output_dir,
        checkpoint_dir,
        poll_interval=poll_interval,
        log=log,
        thresholds=thresholds,
    )


def read_alerts(spark: SparkSession, output_dir: str) -> DataFrame:
    """Alerts written so far, parsed."""
    lines = read_output(spark, output_dir, ALERT)
    return parse_enriched(lines).select(*ENRICHED_FIELDS)


def read_quarantine(spark: SparkSession, output_dir: str) -> DataFrame:
    """Quarantined lines (`value`) written so far."""
    return read_output(spark, output_dir, INVALID)


def read_log(spark: SparkSession, output_dir: str) -> DataFrame:
    """Status lines (`value`) written so far, if the consumer was asked to log."""
    return read_output(spark, output_dir, LOG)
