"""Validation rules and the valid / quarantine split.

Every rule is a Column. `valid_condition` is a conjunction of plain predicates, so filters
on columnar input reach the scan; error arrays are only built for rows that fail it.
Nothing raises on bad input: a line that is not JSON or a field of the wrong type becomes
an error of that row.

Frames from `sources.jsonl.parse_events` carry the line (`value`) and Spark's corrupt-record
column, by which missing keys are told from nulls. On columnar input a null is a missing field.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewatch.functions.rounding import NUMBER_LIMIT
from tapewatch.functions.iso import is_iso_date, is_iso_timestamp
from tapewatch.schema import RAW_FIELDS

# Accepted option types and error texts, in the order they are reported.
OPTION_TYPES = ("CALL", "PUT")
MALFORMED = "malformed JSON"
MISSING_PREFIX = "Missing required field: "
TYPE_SUFFIX = " has invalid type"
LIMIT_SUFFIX = " is too large"
OPTION_TYPE_ERROR = "option_type must be one of {'CALL', 'PUT'}"
VOLUME_ERROR = "volume cannot be negative"
OPEN_INTEREST_ERROR = "open_interest cannot be negative"
BID_ERROR = "bid cannot be negative"
ASK_ERROR = "ask cannot be negative"
CROSSED_ERROR = "bid cannot be greater than ask"
LAST_PRICE_ERROR = "last_price cannot be negative"
STRIKE_ERROR = "strike must be positive"
UNDERLYING_ERROR = "underlying_price must be positive"
IV_ERROR = "implied_volatility must be positive"
TIMESTAMP_ERROR = "event_timestamp must be a valid ISO datetime"
EXPIRATION_ERROR = "expiration_date must be a valid ISO date"

# Numbers the rules compare; a null here is a type error.
CHECKED_NUMBERS = [
    "ask",
    "bid",
    "implied_volatility",
    "last_price",
    "open_interest",
    "strike",
    "underlying_price",
    "volume",
]

# Of these, the ones held as doubles: NaN, infinities and numbers beyond the limit are type errors.
LIMITED_NUMBERS = [name for name in CHECKED_NUMBERS if name not in ("open_interest", "volume")]

# Fields no value rule inspects: null is accepted where the key is present.
UNCHECKED_FIELDS = ["event_id", "symbol", "contract_symbol", "delta", "source"]

ERRORS = "validation_errors"
CORRUPT = "_corrupt_record"


def value_rules() -> list[tuple[str, Column]]:
    """(message, condition a row must meet), in reporting order. Null does not meet it."""
    c = F.col
    return [
        (OPTION_TYPE_ERROR, c("option_type").isin(*OPTION_TYPES)),
        (VOLUME_ERROR, c("volume") >= 0),
        (OPEN_INTEREST_ERROR, c("open_interest") >= 0),
        (BID_ERROR, c("bid") >= 0),
        (ASK_ERROR, c("ask") >= 0),
        (CROSSED_ERROR, c("bid") <= c("ask")),
        (LAST_PRICE_ERROR, c("last_price") >= 0),
        (STRIKE_ERROR, c("strike") > 0),
        (UNDERLYING_ERROR, c("underlying_price") > 0),
        (IV_ERROR, c("implied_volatility") > 0),
        (TIMESTAMP_ERROR, is_iso_timestamp(c("event_timestamp"))),
        (EXPIRATION_ERROR, is_iso_date(c("expiration_date"))),
    ]


def _number_rules() -> list[tuple[str, Column]]:
    """(message, condition) of numbers that are there and can be held; NaN is above every limit."""
    there = [(name + TYPE_SUFFIX, F.col(name).isNotNull()) for name in CHECKED_NUMBERS]
    limit = F.lit(NUMBER_LIMIT)
    within = {name: (F.col(name) < limit) & (F.col(name) > -limit) for name in LIMITED_NUMBERS}
    return there + [(name + LIMIT_SUFFIX, F.coalesce(held, F.lit(True))) for name, held in within.items()]


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def _from_json(df: DataFrame) -> bool:
    return CORRUPT in df.columns


def _single_value() -> Column:
    """Whether the line holds one JSON value and nothing behind it.

    Parsers stop after the first value, so a second event in the same line would be lost.
    In flat events the first "}" ends the line; only other lines are read again. Lengths are
    compared in bytes, as counting the characters of every line costs more than finding "}".
    """
    before = F.substring_index("value", "}", 1)
    flat = F.octet_length(before) == F.octet_length("value") - 1
    values = F.json_array_length(F.concat(F.lit("["), F.col("value"), F.lit("]")))
    return flat | (values == 1)


def is_malformed() -> Column:
    """Whether a parsed line is anything but one JSON object."""
    nothing_parsed = _all([F.col(name).isNull() for name in RAW_FIELDS])
    failed = nothing_parsed & F.col(CORRUPT).isNotNull()
    return failed | ~F.coalesce(_single_value(), F.lit(False))


def valid_condition(df: DataFrame) -> Column:
    """Conjunction that is true for exactly the rows without errors (else false or null)."""
    rules = [met for _, met in value_rules()]
    rules += [F.col(name) < F.lit(NUMBER_LIMIT) for name in LIMITED_NUMBERS]
    present = _all([F.col(name).isNotNull() for name in UNCHECKED_FIELDS])
    if not _from_json(df):
        return _all([present, *rules])
    expected = F.array(*[F.lit(name) for name in UNCHECKED_FIELDS])
    has_keys = F.size(F.array_except(expected, F.json_object_keys("value"))) == 0
    return _all([present | has_keys, *rules, _single_value()])


def is_valid(df: DataFrame) -> Column:
    return F.coalesce(valid_condition(df), F.lit(False))


def _broken(rules: list[tuple[str, Column]]) -> Column:
    """Messages of the rules a row does not meet."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(met, F.lit(False)), message) for message, met in rules])
    )


def _missing_fields(df: DataFrame) -> Column:
    required = F.array(*[F.lit(name) for name in sorted(RAW_FIELDS)])
    if _from_json(df):
        return F.array_except(required, F.json_object_keys("value"))
    return F.array_compact(F.array(*[F.when(F.col(n).isNull(), n) for n in sorted(RAW_FIELDS)]))


def with_validation_errors(df: DataFrame, only: Column | None = None) -> DataFrame:
    """Add `validation_errors`, empty for a valid row; null where `only` is false.

    The first of these that applies is reported alone: malformed line, missing fields,
    numbers of a wrong type or too large, broken value rules.
    """
    missing = F.transform(_missing_fields(df), lambda name: F.concat(F.lit(MISSING_PREFIX), name))
    number_rules = _number_rules()
    has_nulls = ~_all([F.col(name).isNotNull() for name in RAW_FIELDS])
    has_all_numbers = _all([met for _, met in number_rules])
    errors = (
        F.when(has_nulls & (F.size(missing) > 0), missing)
        .when(~has_all_numbers, _broken(number_rules))
        .otherwise(_broken(value_rules()))
    )
    if _from_json(df):
        errors = F.when(is_malformed(), F.array(F.lit(MALFORMED))).otherwise(errors)
    if only is not None:
        errors = F.when(only, errors)
    return df.withColumn(ERRORS, errors)


def valid_events(df: DataFrame) -> DataFrame:
    return df.filter(valid_condition(df))


def invalid_events(df: DataFrame) -> DataFrame:
    """Rows that break a rule, with the reasons."""
    return with_validation_errors(df.filter(~is_valid(df)))


def split_events(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) views of one frame. To write both in one pass see `plans.batch`."""
    return valid_events(df), invalid_events(df)
