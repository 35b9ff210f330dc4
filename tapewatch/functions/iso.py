"""ISO-8601 dates and timestamps, accepted as Python's `fromisoformat` accepts them.

Spark's casts alone are too lenient ("2026", "T13:45", padded text) and read naive
values in the session time zone; here the extended form is required and the result
is a UTC wall clock that does not depend on the session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"(?!0000)\d{4}-\d{2}-\d{2}"
_CLOCK = r"\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?"
_OFFSET = r"Z|[+-](?:[01]\d|2[0-3])(?:[0-5]\d(?:[0-5]\d)?|:[0-5]\d(?::[0-5]\d)?)?"

DATE_PATTERN = rf"^{_DATE}\z"
TIMESTAMP_PATTERN = rf"^{_DATE}(?:[T ]{_CLOCK}(?:{_OFFSET})?)?\z"

# sign, hours, minutes and seconds of what `_OFFSET` matches, "Z" apart
_OFFSET_PARTS = r"([+-])(\d{2}):?(\d{2})?:?(\d{2})?\z"


def is_iso_date(text: Column) -> Column:
    return text.rlike(DATE_PATTERN) & text.try_cast("date").isNotNull()


def iso_date(text: Column) -> Column:
    """DATE of a `yyyy-MM-dd` string, null when it is not one."""
    return F.when(text.rlike(DATE_PATTERN), text.try_cast("date"))


def _tail(text: Column) -> Column:
    """What follows the date."""
    return F.substring(text, 11, 64)


def _has_offset(text: Column) -> Column:
    tail = _tail(text)
    return tail.endswith("Z") | tail.contains("+") | tail.contains("-")


def _wall_clock(text: Column) -> Column:
    """TIMESTAMP_NTZ as written, without the offset. Plain text, by far the most common, is left alone."""
    bare = F.regexp_replace(F.replace(_tail(text), F.lit(","), F.lit(".")), r"(?:Z|[+-].*)\z", "")
    plain = ~_has_offset(text) & ~text.contains(",")
    return F.when(plain, text).otherwise(F.concat(F.substring(text, 1, 10), bare)).try_cast("timestamp_ntz")


def _offset(text: Column) -> Column:
    """How far the wall clock is ahead of UTC."""
    sign, *parts = (F.regexp_extract(_tail(text), _OFFSET_PARTS, group) for group in range(1, 5))
    hours, minutes, seconds = (F.coalesce(part.try_cast("int"), F.lit(0)) for part in parts)
    size = hours * 3600 + minutes * 60 + seconds
    return F.make_dt_interval(secs=F.when(sign == "-", -size).otherwise(size).cast("decimal(18,6)"))


def is_iso_timestamp(text: Column) -> Column:
    return text.rlike(TIMESTAMP_PATTERN) & _wall_clock(text).isNotNull()


def iso_timestamp(text: Column) -> Column:
    """TIMESTAMP_NTZ in UTC of an ISO string, null when it is not one. Naive text is kept as is.

    The offset, of up to a day, is subtracted here, as a cast would go through the session's zone and
    refuse offsets beyond 18 hours.
    """
    clock = _wall_clock(text)
    in_utc = ~_has_offset(text) | text.endswith("Z") | text.endswith("+00:00")
    return F.when(
        text.rlike(TIMESTAMP_PATTERN),
        F.when(in_utc, clock).otherwise(clock - _offset(text)),
    )


def hour_start(timestamp: Column) -> Column:
    """A TIMESTAMP_NTZ cut to the hour. `date_trunc` would go through the session time zone."""
    past = F.make_dt_interval(mins=F.minute(timestamp), secs=F.extract(F.lit("SECOND"), timestamp))
    return timestamp - past
