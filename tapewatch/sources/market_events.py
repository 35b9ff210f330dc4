"""Options events derived from a generic `events(event_id, ts, user_id, value, props)` table.

The projection is integer arithmetic on the row itself, so any SQL engine can repeat it
bit for bit. Prime moduli of the event id inject one fault each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.schema import RAW_FIELDS
from tapewatch.sources.jsonl import json_lines

# Invented tickers and their base prices in cents, by `user_id % 8`.
TICKERS = ["ORBT", "KELP", "FJRD", "QUAY", "MOSQ", "VANE", "TARN", "ZEPH"]
BASE_CENTS = [31200, 9800, 14350, 27600, 45150, 12075, 58800, 20640]


def _pick(values: list, index: str) -> str:
    items = ", ".join(repr(value) for value in values)
    return f"element_at(array({items}), cast({index} as int) + 1)"


def _faulty(modulus: int, fault: str, value: str) -> Column:
    return F.expr(f"case when e % {modulus} = 0 then {fault} else {value} end")


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that events are derived from.

    They are a fraction of a line's bytes, so rows are sorted or dealt out here and not as lines.
    """
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "value", "props")


def options_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 raw fields, typed; a null symbol stands for an absent key."""
    return project_events(source_events(spark, sf_dir)).select(*RAW_FIELDS)


def project_events(events: DataFrame) -> DataFrame:
    """As `options_events`, with the numeric id kept as `e`."""
    base = events.select(
        F.col("event_id").alias("e"),
        "ts",
        F.col("user_id").alias("u"),
        F.col("value").alias("v"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    steps = base.select(
        "*",
        F.expr(_pick(TICKERS, "u % 8")).alias("sym"),
        F.expr(
            f"(cast({_pick(BASE_CENTS, 'u % 8')} as bigint) * (9700 + (e * 7919) % 601)) div 10000"
        ).alias("und_c"),
        F.expr("10 + (e * 37) % 5000").alias("bid_c"),
        F.expr("date_add(cast(ts as date), cast(7 + e % 54 as int))").alias("ex"),
    ).withColumn("strike_c", F.expr("((und_c + ((e * 31) % 17) * 500 - 4000) div 500) * 500"))
    side = "case when e % 2 = 0 then 'CALL' else 'PUT' end"
    expiry = "cast(ex as string)"
    fields = {
        "event_id": F.expr("concat('evt_', e)"),
        "symbol": _faulty(107, "null", "sym"),
        "contract_symbol": F.expr(
            "concat_ws('_', sym, replace(cast(ex as string), '-', ''), "
            "lpad(strike_c * 10, 8, '0'), case when e % 2 = 0 then 'C' else 'P' end)"
        ),
        "expiration_date": _faulty(101, "'2024-02-30'", expiry),
        "strike": _faulty(113, "0", "strike_c / 100D"),
        "option_type": _faulty(61, "'SELL'", side),
        "bid": _faulty(137, "-0.01D", "bid_c / 100D"),
        "ask": F.expr(
            "case when e % 131 = 0 then -0.02D when e % 71 = 0 then (bid_c - 5) / 100D "
            "else (bid_c + 1 + e % 75) / 100D end"
        ),
        "last_price": _faulty(109, "-0.01D", "bid_c / 100D"),
        "volume": _faulty(53, "-1", "cast(floor(v * 40) as int)"),
        "open_interest": F.expr(
            "cast(case when e % 97 = 0 then 0 when e % 83 = 0 then -5 "
            "else 50 + (e * 7919 + k * 131) % 15000 end as int)"
        ),
        "implied_volatility": _faulty(
            89, "0D", "(1500 + (e * 104729) % 10501) / 10000D"
        ),
        "delta": F.expr("((e * 13) % 181 - 90) / 100D"),
        "underlying_price": _faulty(127, "0", "und_c / 100D"),
        "event_timestamp": _faulty(
            103, "'not-a-timestamp'", "replace(substr(cast(ts as string), 1, 19), ' ', 'T')"
        ),
        "source": F.lit("events"),
    }
    # Through a generator, so that a filter on a field does not compute the field again.
    row = F.struct("e", *[column.alias(name) for name, column in fields.items()])
    return steps.select(F.inline(F.array(row)))


def options_lines(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """The same events as JSON lines (`value`), dealt into `parts`; null fields become absent keys."""
    events = source_events(spark, sf_dir)
    if parts:
        # by columns: dealt in turn, every task would sort its rows first
        events = events.repartition(parts, "event_id", "ts", "user_id")
    lines = json_lines(project_events(events).select(*RAW_FIELDS), keep_nulls=False)
    return lines.select(F.inline(F.array(F.struct("value"))))


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as lines (`value`) in order, as careless senders write them.

    Ids that repeat the one before, offsets, a null source, lines that are cut, doubled, padded or
    followed by a blank one, numbers with fractions or quotes; each by a modulus of the event id.
    """
    e, time = F.col("e"), F.col("event_timestamp")
    offset = F.when(e % 7 == 3, F.lit("+02:30")).when(e % 29 == 5, F.lit("-23:15")).otherwise("")
    events = project_events(source_events(spark, sf_dir).orderBy("event_id")).select(
        "e",
        F.when(e % 19 == 4, F.concat(F.lit("evt_"), e - 1)).otherwise(F.col("event_id")).alias("event_id"),
        F.when(time.endswith("p"), time).otherwise(F.concat(time, offset)).alias("event_timestamp"),
        *[name for name in RAW_FIELDS if name not in ("event_id", "event_timestamp")],
    )
    text = F.to_json(F.struct(*RAW_FIELDS), {"ignoreNullFields": "true"})
    no_source = F.replace(text, F.lit('"source":"events"'), F.lit('"source":null'))
    line = events.select("e", F.when(e % 31 == 7, no_source).otherwise(text).alias("line"))
    whole, volume = F.col("line"), r'("volume":-?\d+)'
    written = (
        F.when(e % 11 == 1, F.expr("substr(line, 1, length(line) - 1)"))
        .when(e % 11 == 2, F.concat(F.lit("  "), whole, F.lit("\t")))
        .when(e % 11 == 3, F.regexp_replace(whole, volume, "$1.0"))
        .when(e % 11 == 4, F.regexp_replace(whole, volume, "$1.5"))
        .when(e % 11 == 5, F.regexp_replace(whole, r'"strike":([-+.E\d]+)', '"strike":"$1"'))
        .when(e % 11 == 6, F.concat(whole, whole))
        .otherwise(whole)
    )
    blank = F.when(e % 23 == 0, F.lit("   "))
    return line.select(F.explode(F.array_compact(F.array(written, blank))).alias("value"))
