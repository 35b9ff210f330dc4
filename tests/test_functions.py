from __future__ import annotations

import random
from datetime import date, datetime, timezone
from decimal import ROUND_HALF_UP, Decimal

import pytest
from helpers import event, events_frame
from pyspark.sql import functions as F

from tapewatch.functions import iso, rounding, text
from tapewatch.functions.activity import Thresholds
from tapewatch.operators.enrich import enrich, with_types

TIMESTAMPS = [
    "2026-05-29T13:45:00", "2026-05-29", "2026-05-29 13:45", "2026-05-29T13",
    "2026-05-29T13:45:00Z", "2026-05-29T13:45:00+05:30", "2026-05-29T13:45:00+0530",
    "2026-05-29T13:45:00-05:30:15", "2026-05-29T13:45:00.123456", "2026-05-29T13:45:00.1234567",
    "2026-05-29T13:45:00.1", "2026-05-29T13:45:00,123", "2026-05-29T24:00:00",
    "2026-05-29T23:60:00", "2026-02-30T00:00:00", "2026-05-29T13:45:60", "2026-05-29T13:45+05",
    "2026-05-29T13Z", "2026-05-29T13:45:00.5+01:00", "2026-05-29T13:45:00+24:00",
    "2026-05-29T13:45:00-00:00", "2026-05-29T13:45:00+5:30", "2026-05-29T13:45:00z", "2026",
    "2026-05", "T13:45", " 2026-05-29", "2026-05-29 ", "2026-5-9", "", "x", "2026-13-01",
    "0000-01-01", "2026-05-29T13:45:00+05:3015", "9999-12-31T23:59:59", "2024-02-29T00:00",
    "2023-02-29", "2026-05-29T13:45:00+", "2026-05-29T", "2026-05-29T13:45:00+23:59",
    "2026-05-29T13-19", "2026-05-29 01:45:00,5-20:00:30", "2026-05-29T13:45:00+18:00:01",
    "2026-05-29T13:45:00-2359", "2026-05-29T13:45Z", "2026-12-31T23:59:59.999999-23:59:59",
]

DATES = ["2026-05-29", "2026-02-30", "2024-02-29", "2023-02-29", "2026-5-9", " 2026-05-29",
         "2026-05-29T00:00:00", "0000-01-01", "", "x", "2026", "9999-12-31"]


def python_timestamp(value):
    try:
        parsed = datetime.fromisoformat(value)
    except ValueError:
        return None
    if parsed.tzinfo:
        parsed = parsed.astimezone(timezone.utc).replace(tzinfo=None)
    return parsed


def python_date(value):
    try:
        return date.fromisoformat(value)
    except ValueError:
        return None


def test_timestamps_as_python_reads_them(spark):
    frame = spark.createDataFrame([(value,) for value in [*TIMESTAMPS, None]], "v string")
    c = F.col("v")
    expected = {value: python_timestamp(value) for value in TIMESTAMPS} | {None: None}
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            rows = frame.select("v", iso.iso_timestamp(c), iso.is_iso_timestamp(c)).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert {row[0]: row[1] for row in rows} == expected
        assert {row[0]: bool(row[2]) for row in rows} == {
            value: parsed is not None for value, parsed in expected.items()
        }


def test_dates_as_python_reads_them(spark):
    frame = spark.createDataFrame([(value,) for value in [*DATES, None]], "v string")
    rows = frame.select("v", iso.iso_date(F.col("v")), iso.is_iso_date(F.col("v"))).collect()
    expected = {value: python_date(value) for value in DATES} | {None: None}
    assert {row[0]: row[1] for row in rows} == expected
    assert {row[0]: bool(row[2]) for row in rows} == {
        value: parsed is not None for value, parsed in expected.items()
    }


def test_hour_start(spark):
    frame = spark.sql("select timestamp_ntz'2026-03-08 02:45:10.25' as t")
    assert frame.select(iso.hour_start(F.col("t"))).first()[0] == datetime(2026, 3, 8, 2)


def test_ratio_rounds_half_up(spark):
    pairs = [(1, 32), (333, 1000), (1, 3), (0, 7), (10, 0), (2147483647, 1), (640, 15500), (3, 32)]
    frame = spark.createDataFrame(pairs, "v int, o int")
    rows = frame.select("v", "o", rounding.ratio4(F.col("v"), F.col("o")).alias("r")).collect()
    for row in rows:
        expected = (
            None
            if row.o == 0
            else float((Decimal(row.v) / row.o).quantize(Decimal("0.0001"), ROUND_HALF_UP))
        )
        assert row.r == expected


def test_mean_is_exact_and_order_free(spark):
    rng = random.Random(3)
    values = [round(rng.uniform(0.15, 1.2), 4) for _ in range(999)]
    exact = sum(Decimal(str(value)) for value in values) / len(values)
    expected = float(exact.quantize(Decimal("0.0001"), ROUND_HALF_UP))
    frame = spark.createDataFrame([(value,) for value in values], "v double")
    for parts in (1, 3, 7):
        spread = frame.repartition(parts)
        assert spread.agg(rounding.mean4(F.col("v"))).first()[0] == expected


def test_mean_is_exact_up_to_the_limit(spark):
    frame = spark.createDataFrame([(0.0001,), (99999999999999.0,), (1.0,)], "v double")
    assert frame.agg(rounding.mean4(F.col("v"))).first()[0] == 33333333333333.3334
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CAST_OVERFLOW"):
        spark.createDataFrame([(3e15,)], "v double").agg(rounding.mean4(F.col("v"))).collect()


def test_quotient_of_large_sums(spark):
    pairs = [(9_000_000_000_000_000, 7_000_000), (9_000_000_000_000_000, 11), (1, 3), (0, 5), (0, 0)]
    frame = spark.createDataFrame(pairs, "t bigint, n bigint")
    got = [r[0] for r in frame.select(rounding.quotient4(F.col("t"), F.col("n"))).collect()]
    assert got == [1285714285.7143, 818181818181818.1818, 0.3333, 0.0, None]


FLAG_CASES = [
    ({"volume": 5000}, ["HIGH_VOLUME"]),
    ({"volume": 4999}, []),
    ({"volume": 1500, "open_interest": 1200}, ["VOLUME_EXCEEDS_OPEN_INTEREST"]),
    ({"volume": 777, "open_interest": 777}, ["VOLUME_EXCEEDS_OPEN_INTEREST"]),
    ({"volume": 776, "open_interest": 777}, []),
    ({"implied_volatility": 0.80}, ["HIGH_IV"]),
    ({"implied_volatility": 0.7999}, []),
    (
        {"volume": 7100, "open_interest": 6400, "implied_volatility": 0.88},
        ["HIGH_VOLUME", "VOLUME_EXCEEDS_OPEN_INTEREST", "HIGH_IV"],
    ),
    ({"open_interest": 0, "volume": 36}, []),
    ({}, []),
]


def test_flags_and_score(spark):
    rows = [event(event_id=str(i), **changes) for i, (changes, _) in enumerate(FLAG_CASES)]
    found = {row.event_id: row for row in enrich(events_frame(spark, rows)).collect()}
    for i, (_, flags) in enumerate(FLAG_CASES):
        assert found[str(i)].unusual_activity_flags == flags
        assert found[str(i)].unusual_activity_score == len(flags)
    assert found["8"].volume_open_interest_ratio is None
    assert found["9"].volume_open_interest_ratio == 0.0413


def test_thresholds_are_parameters(spark):
    limits = Thresholds(volume=600, volume_to_open_interest=0.04, implied_volatility=0.3)
    row = enrich(events_frame(spark, [event()]), limits).first()
    assert row.unusual_activity_score == 3


def test_typed_form(spark):
    row = with_types(
        enrich(events_frame(spark, [event(event_timestamp="2026-05-29T23:45:00-05:00")]))
    ).first()
    assert row.event_timestamp == datetime(2026, 5, 30, 4, 45)
    assert row.event_date == date(2026, 5, 30)
    assert row.event_hour == 4
    assert row.expiration_date == date(2026, 12, 18)


def test_log_lines(spark):
    frame = enrich(events_frame(spark, [event(volume=16000), event(event_id="b", symbol=...)]))
    rows = frame.select(
        text.event_summary(),
        text.processing_summary(
            F.col("symbol").isNotNull(),
            F.col("unusual_activity_score"),
            F.col("unusual_activity_flags"),
        ),
    ).collect()
    assert rows[0][0] == (
        "event_id=evt_a symbol=ORBT contract_symbol=ORBT_20261218_00084000_P "
        "volume=16000 open_interest=15500 implied_volatility=0.312"
    )
    assert rows[0][1] == (
        "event_id=evt_a symbol=ORBT status=valid unusual_activity_score=2 "
        "flags=HIGH_VOLUME|VOLUME_EXCEEDS_OPEN_INTEREST"
    )
    assert rows[1][1] == (
        "event_id=b symbol=None status=invalid unusual_activity_score=0 flags=NONE"
    )
