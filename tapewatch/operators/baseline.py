"""Volume of a contract against its own past.

The past is kept as moments: per key and day the number of events, the sum and the sum of squares.
Moments add up exactly, so a window of days is a sum of rows, and a day that is computed again
replaces its rows without touching the others. Only whole days before an event's day count for it,
so nothing that is delivered on a day can shift that day's baseline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONTRACT = ("contract_symbol",)
WINDOW_DAYS = 20
MIN_EVENTS = 3
Z_LIMIT = 3.0

#: Scores are exact for measures of 31 bits and up to 2e9 events of a key within the window: their
#: squares stay below 1e28. Beyond, casts raise in ANSI mode, Spark's default.
_WIDE = "decimal(38,0)"


def daily_moments(
    typed_events: DataFrame, keys: Sequence[str] = CONTRACT, measure: str = "volume"
) -> DataFrame:
    """One row per key and day: n, total, squares of an integer measure.

    Nulls of the measure and events without a day are left out. Combined before the shuffle, so a
    hot contract sends one row per task and day.
    """
    value = F.col(measure).cast("bigint")
    there = typed_events.filter(F.col(measure).isNotNull() & F.col("event_date").isNotNull())
    return there.groupBy(*keys, "event_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(value.cast("decimal(20,0)")).cast(_WIDE).alias("total"),
        F.sum((value * value).cast("decimal(20,0)")).cast(_WIDE).alias("squares"),
    )


def merged_moments(moments: DataFrame, keys: Sequence[str] = CONTRACT) -> DataFrame:
    """Moments of parts of the same days, put together."""
    return moments.groupBy(*keys, "event_date").agg(
        F.sum("n").alias("n"),
        F.sum("total").cast(_WIDE).alias("total"),
        F.sum("squares").cast(_WIDE).alias("squares"),
    )


def baselines(moments: DataFrame, keys: Sequence[str] = CONTRACT, days: int = WINDOW_DAYS) -> DataFrame:
    """For each key and day of `moments` the moments of the `days` days before it.

    base_n is 0, and the sums null, where there were none. A key has one row per day, so the
    frames of the window are bounded by the days, whatever the number of events.
    """
    day = F.datediff("event_date", F.lit("1970-01-01").cast("date"))
    before = Window.partitionBy(*keys).orderBy(day).rangeBetween(-days, -1)
    return moments.select(
        *keys,
        "event_date",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_n"),
        F.sum("total").over(before).cast(_WIDE).alias("base_total"),
        F.sum("squares").over(before).cast(_WIDE).alias("base_squares"),
    )


def z_score(value: Column) -> Column:
    """(value - mean) / standard deviation of the baseline, half-up at 4 decimals.

    Null where the deviation is zero or there is no baseline. The numerators n * value - total and
    n * squares - total^2 are exact; only their root and quotient are doubles.
    """
    n = F.col("base_n").cast("decimal(10,0)")
    total, squares = F.col("base_total").cast("decimal(19,0)"), F.col("base_squares").cast("decimal(28,0)")
    above = (n * value.cast("decimal(10,0)") - total).cast("double")
    spread = (n * squares - total * total).cast("double")
    scaled = above / F.sqrt(spread) * F.lit(10000.0) + F.lit(0.5)
    return F.when(spread > 0, F.floor(scaled).cast("double") / F.lit(10000.0))


def against_baseline(
    typed_events: DataFrame,
    moments: DataFrame,
    keys: Sequence[str] = CONTRACT,
    measure: str = "volume",
    days: int = WINDOW_DAYS,
    min_events: int = MIN_EVENTS,
    limit: float = Z_LIMIT,
) -> DataFrame:
    """Every event with base_n, z_score and above_baseline.

    An event is above if its key has `min_events` in the days before and the z-score reaches
    `limit`. A key whose past values are all equal has no deviation: any larger value is above.
    Events without a key, or of a day that `moments` does not hold, have base_n null and are not
    above. The baseline has one row per key and day; a key that holds much of a day is split by
    adaptive execution on the side of the events, and Spark broadcasts baselines only if its own
    estimate allows.
    """
    base = baselines(moments, keys, days)
    columns = ["base_n", "base_total", "base_squares"]
    joined = typed_events.join(base, [*keys, "event_date"], "left")
    value = F.col(measure)
    score = z_score(value)
    flat = F.col("base_n").cast("decimal(10,0)") * F.col("base_squares").cast("decimal(28,0)") == F.col(
        "base_total"
    ).cast("decimal(19,0)") * F.col("base_total").cast("decimal(19,0)")
    beyond = F.when(flat, F.col("base_n") * value > F.col("base_total")).otherwise(score >= F.lit(limit))
    above = (F.col("base_n") >= min_events) & beyond
    kept = [name for name in typed_events.columns if name not in columns]
    return joined.select(
        *kept, "base_n", score.alias("z_score"), F.coalesce(above, F.lit(False)).alias("above_baseline")
    )
