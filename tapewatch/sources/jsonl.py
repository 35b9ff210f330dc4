"""JSON-lines input and output.

Lines are read as text and parsed against a fixed schema, so there is no inference
pass and a bad line stays a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewatch.functions.text import enriched_line, quarantine_line
from tapewatch.operators.first_wins import SOURCE_ORDER
from tapewatch.operators.validate import CORRUPT, ERRORS, MALFORMED, is_malformed
from tapewatch.schema import ENRICHED_FIELDS, ENRICHED_SCHEMA, RAW_SCHEMA

# Fixed value: the characters Python's `str.strip` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def strip_lines(lines: DataFrame) -> DataFrame:
    """Trim `value` and skip blank lines; other columns ride along."""
    line = F.col("value")
    bare = line.startswith("{") & line.endswith("}")
    stripped = F.when(bare, line).otherwise(F.btrim(line, F.lit(WHITESPACE)))
    return lines.withColumn("value", stripped).filter(F.col("value") != "")


def read_lines(spark: SparkSession, path: str, with_order: bool = False) -> DataFrame:
    """Non-blank lines of a file or directory.

    `with_order` records each line's place in the input, for first-wins in input order.
    """
    lines = spark.read.text(path)
    if with_order:
        place = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        )
        lines = lines.select("value", place.alias(SOURCE_ORDER))
    return strip_lines(lines)


def _whole(number: Column) -> Column:
    """An INT of a number without a fraction, `1200.0` and `1.2e3` included; null of any other."""
    whole = number.try_cast("int")
    return F.when(whole == number, whole)


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Flatten `from_json` through a generator.

    A plain projection would let filters on the fields be pushed below it, and each pushed
    reference would parse the line again. Filters do not pass a generator's own output.
    Whole numbers may be written as floats, so they are read as such; a double holds every INT.
    """
    integers = {field.name for field in schema.fields if isinstance(field.dataType, T.IntegerType)}
    read = [
        T.StructField(field.name, T.DoubleType()) if field.name in integers else field for field in schema.fields
    ]
    with_corrupt = T.StructType([*read, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", with_corrupt, JSON_OPTIONS)
    flat = lines.select("*", F.inline(F.array(parsed)))
    return flat.withColumns({name: _whole(F.col(name)) for name in sorted(integers)})


def parse_events(lines: DataFrame, fail_fast: bool = False) -> DataFrame:
    """Raw events from stripped lines: the line, the 16 fields and the corrupt-record column.

    `fail_fast` ends the job at the first line that is not a JSON object.
    """
    parsed = _parsed(lines, RAW_SCHEMA)
    if fail_fast:
        message = F.concat(F.lit("not a JSON object: "), F.col("value"))
        checked = F.when(is_malformed(), F.raise_error(message).cast("boolean")).otherwise(True)
        parsed = parsed.filter(checked)
    return parsed


def read_events(
    spark: SparkSession, path: str, with_order: bool = False, fail_fast: bool = False
) -> DataFrame:
    return parse_events(read_lines(spark, path, with_order), fail_fast)


def parse_enriched(lines: DataFrame) -> DataFrame:
    """Enriched events from stripped lines; the line itself is kept as `value`."""
    return _parsed(lines, ENRICHED_SCHEMA).drop(CORRUPT)


def read_enriched(spark: SparkSession, path: str, with_order: bool = False) -> DataFrame:
    """Enriched events written by this package or any producer of the same fields."""
    order = [SOURCE_ORDER] if with_order else []
    lines = read_lines(spark, path, with_order)
    return parse_enriched(lines).select(*ENRICHED_FIELDS, *order)


def json_lines(df: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """One JSON object per row as `value`. `keep_nulls=False` leaves null fields out."""
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(F.to_json(F.struct(*df.columns), options).alias("value"))


def enriched_text() -> Column:
    """JSON line of an enriched event that still carries its raw line; unknown fields survive."""
    return enriched_line(F.col("value"))


def quarantine_text() -> Column:
    """JSON line of an invalid event that still carries its raw line."""
    is_object = ~F.array_contains(ERRORS, MALFORMED)
    return quarantine_line(F.col("value"), F.col(ERRORS), is_object)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write rows as JSON lines with nulls spelled out."""
    json_lines(df).write.mode(mode).text(path)
