"""Checks of what arrives: shares of nulls, drift of distributions, freshness.

The profile of a day is a count per field and bin, taken for all fields in one pass. Counts add up
exactly, so profiles of parts of a day can be merged and stored. A day is compared with the days
before it by the total variation distance: the largest difference that the two give to any set of
bins. Null is a bin of its own, so a field that stops being filled drifts as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewatch.functions.iso import iso_timestamp

# Limits between bins: a value falls into the bin numbered by how many limits it reaches.
EDGES: dict[str, list[float]] = {
    "volume": [0, 1, 10, 50, 100, 500, 1000, 5000, 10000, 50000],
    "open_interest": [0, 1, 100, 500, 1000, 5000, 10000, 50000],
    "implied_volatility": [0, 0.1, 0.2, 0.4, 0.6, 0.8, 1.0, 2.0],
    "strike": [0, 10, 50, 100, 200, 500, 1000],
}
#: Each value of these is a bin; they must have few values.
NAMES = ["symbol", "option_type"]
DAYS = 7
LIMIT = 200_000
MIN_ROWS = 100


def _bin(field: str, edges: Sequence[float]) -> Column:
    """NaN is beyond every limit."""
    value = F.col(field)
    number = F.lit(0)
    for edge in edges:
        number = number + (value >= F.lit(edge)).cast("int")
    return number.cast("string")


def daily_profile(
    events: DataFrame, edges: Mapping[str, Sequence[float]] = EDGES, names: Sequence[str] = NAMES
) -> DataFrame:
    """(event_date, field, bin, n) of raw or enriched events; bin null for nulls.

    Events without a readable time have event_date null. Events are combined before the shuffle:
    a task sends a row per day, field and bin, however frequent a symbol is.
    """
    clock = F.col("event_timestamp")
    if dict(events.dtypes)["event_timestamp"] == "string":
        clock = iso_timestamp(clock)
    values = [F.struct(F.lit(field).alias("field"), _bin(field, limits).alias("bin")) for field, limits in edges.items()]
    values += [F.struct(F.lit(name).alias("field"), F.col(name).cast("string").alias("bin")) for name in names]
    binned = events.select(F.to_date(clock).alias("event_date"), F.array(*values).alias("values"))
    rows = binned.select("event_date", F.inline("values"))
    return rows.groupBy("event_date", "field", "bin").agg(F.count(F.lit(1)).alias("n"))


def merged_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles of parts of the same days, put together."""
    return profiles.groupBy("event_date", "field", "bin").agg(F.sum("n").alias("n"))


def _before(days: int, *keys: str) -> Window:
    day = F.datediff("event_date", F.lit("1970-01-01").cast("date"))
    return Window.partitionBy(*keys).orderBy(day).rangeBetween(-days, -1)


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(15,0)")


def daily_checks(
    profile: DataFrame, days: int = DAYS, limit: int = LIMIT, min_rows: int = MIN_ROWS
) -> DataFrame:
    """One row per day and field of a profile: rows, null share, distance from the days before.

    `distance_per_million` compares with the `days` days before and is null where they have no rows;
    `drifted` says that it reaches `limit` and that both sides have `min_rows` at least. Shares are
    cut to whole millionths of exact fractions. Rows without a day are left out.

    A drifted day takes part in the base of the days after it, by its share of their rows; to keep it
    out, leave its rows out of the profile once it is handled.

    Bins that only the days before have need no row: their part is what the other bins leave.
    """
    dated = profile.filter(F.col("event_date").isNotNull())
    totals = dated.groupBy("event_date", "field").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("bin").isNull(), F.col("n"))), F.lit(0)).alias("nulls")
    )
    totals = totals.withColumn("base_rows", F.coalesce(F.sum("rows").over(_before(days, "field")), F.lit(0)))
    based = dated.withColumn("base_n", F.coalesce(F.sum("n").over(_before(days, "field", "bin")), F.lit(0)))
    # counts below 1e15: products and their sums stay below 1e32, and below 1e38 as millionths
    apart = F.abs(_wide("n") * _wide("base_rows") - _wide("base_n") * _wide("rows"))
    sides = based.join(totals, ["event_date", "field"]).groupBy("event_date", "field", "rows", "nulls", "base_rows")
    summed = sides.agg(F.sum(apart.cast("decimal(28,0)")).alias("apart"), F.sum("base_n").alias("met"))
    unmet = _wide("rows") * (_wide("base_rows") - _wide("met"))
    twice = (F.col("apart") + unmet).cast("decimal(32,0)") * F.lit(1_000_000)
    both = (_wide("rows") * _wide("base_rows")).cast("decimal(31,0)") * F.lit(2)
    distance = F.when(F.col("base_rows") > 0, F.call_function("div", twice, both))
    nulls = F.call_function("div", F.col("nulls") * F.lit(1_000_000), F.col("rows"))
    drifted = (distance >= limit) & (F.col("rows") >= min_rows) & (F.col("base_rows") >= min_rows)
    return summed.select(
        "event_date",
        "field",
        "rows",
        "nulls",
        nulls.alias("nulls_per_million"),
        "base_rows",
        distance.alias("distance_per_million"),
        F.coalesce(drifted, F.lit(False)).alias("drifted"),
    )


def freshness(events: DataFrame, now: Column, limit_seconds: int, by: str = "source") -> DataFrame:
    """Per key the latest readable event time and whether it is more than `limit_seconds` before `now`.

    `now` is a UTC wall clock (timestamp_ntz). A key without any readable time is stale.
    """
    clock = F.col("event_timestamp")
    if dict(events.dtypes)["event_timestamp"] == "string":
        clock = iso_timestamp(clock)
    latest = events.groupBy(by).agg(F.max(clock).alias("latest"))
    age = F.timestamp_diff("SECOND", F.col("latest"), now)
    return latest.select(by, "latest", age.alias("age_seconds"), F.coalesce(age > limit_seconds, F.lit(True)).alias("stale"))
