"""Text forms of events: piped flags, log lines, JSON lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def piped_flags(flags: Column) -> Column:
    return F.array_join(flags, "|")


def _pair(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("None")))


def event_summary() -> Column:
    """`key=value` line of an incoming event."""
    names = [
        "event_id",
        "symbol",
        "contract_symbol",
        "volume",
        "open_interest",
        "implied_volatility",
    ]
    return F.concat_ws(" ", *[_pair(name, F.col(name)) for name in names])


def processing_summary(valid: Column, score: Column, flags: Column) -> Column:
    """`key=value` line saying how an event was handled."""
    return F.concat_ws(
        " ",
        _pair("event_id", F.col("event_id")),
        _pair("symbol", F.col("symbol")),
        _pair("status", F.when(valid, "valid").otherwise("invalid")),
        _pair("unusual_activity_score", score),
        _pair("flags", F.when(F.size(flags) > 0, piped_flags(flags)).otherwise("NONE")),
    )


def _append_members(line: Column, *members: Column) -> Column:
    """Add members to the end of a JSON object's text, keeping every field it already has."""
    body = F.rtrim(F.substr(line, F.lit(1), F.length(line) - 1))
    comma = F.when(F.endswith(body, F.lit("{")), "").otherwise(", ")
    return F.concat(body, comma, F.concat_ws(", ", *members), F.lit("}"))


def enriched_line(line: Column) -> Column:
    """The raw JSON object with the three derived fields appended."""
    ratio = F.coalesce(F.col("volume_open_interest_ratio").cast("string"), F.lit("null"))
    return _append_members(
        line,
        F.concat(F.lit('"unusual_activity_flags": '), F.to_json("unusual_activity_flags")),
        F.concat(F.lit('"unusual_activity_score": '), F.col("unusual_activity_score")),
        F.concat(F.lit('"volume_open_interest_ratio": '), ratio),
    )


def quarantine_line(line: Column, errors: Column, is_object: Column) -> Column:
    """The raw JSON object with its errors appended; text that is no object is kept as a string."""
    appended = _append_members(line, F.concat(F.lit('"validation_errors": '), F.to_json(errors)))
    wrapped = F.to_json(F.struct(line.alias("raw_line"), errors.alias("validation_errors")))
    return F.when(is_object, appended).otherwise(wrapped)
