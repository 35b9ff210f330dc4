from __future__ import annotations

import pytest
from helpers import event, events_frame, lines_frame, write_lines
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tapewatch.operators import validate as v
from tapewatch.schema import RAW_SCHEMA
from tapewatch.sources.jsonl import parse_events, read_events, read_lines, strip_lines

CASES = {
    "valid": (event(), []),
    "one key absent": (event(symbol=...), [v.MISSING_PREFIX + "symbol"]),
    "absent keys hide other errors": (
        event(symbol=..., ask=..., volume=-1),
        [v.MISSING_PREFIX + "ask", v.MISSING_PREFIX + "symbol"],
    ),
    "empty object": ({}, [v.MISSING_PREFIX + name for name in sorted(RAW_SCHEMA.names)]),
    "option type": (event(option_type="SELL"), [v.OPTION_TYPE_ERROR]),
    "option type null": (event(option_type=None), [v.OPTION_TYPE_ERROR]),
    "volume": (event(volume=-1), [v.VOLUME_ERROR]),
    "open interest": (event(open_interest=-1), [v.OPEN_INTEREST_ERROR]),
    "open interest zero": (event(open_interest=0), []),
    "crossed": (event(bid=5.0, ask=4.0), [v.CROSSED_ERROR]),
    "negative quotes": (event(bid=-2.0, ask=-1.0), [v.BID_ERROR, v.ASK_ERROR]),
    "last price": (event(last_price=-0.01), [v.LAST_PRICE_ERROR]),
    "strike": (event(strike=0), [v.STRIKE_ERROR]),
    "underlying": (event(underlying_price=0), [v.UNDERLYING_ERROR]),
    "iv": (event(implied_volatility=0), [v.IV_ERROR]),
    "timestamp": (event(event_timestamp="not-a-timestamp"), [v.TIMESTAMP_ERROR]),
    "timestamp null": (event(event_timestamp=None), [v.TIMESTAMP_ERROR]),
    "timestamp year": (event(event_timestamp="2026"), [v.TIMESTAMP_ERROR]),
    "timestamp time": (event(event_timestamp="T13:45"), [v.TIMESTAMP_ERROR]),
    "timestamp number": (event(event_timestamp=20260529), [v.TIMESTAMP_ERROR]),
    "expiration": (event(expiration_date="2026-02-30"), [v.EXPIRATION_ERROR]),
    "expiration with time": (
        event(expiration_date="2026-12-18T00:00:00"),
        [v.EXPIRATION_ERROR],
    ),
    "many": (
        event(option_type="X", volume=-1, strike=-1.0, expiration_date="no"),
        [v.OPTION_TYPE_ERROR, v.VOLUME_ERROR, v.STRIKE_ERROR, v.EXPIRATION_ERROR],
    ),
    "number null": (event(volume=None), ["volume" + v.TYPE_SUFFIX]),
    "number quoted": (event(strike="84"), ["strike" + v.TYPE_SUFFIX]),
    "number text": (event(bid="x", volume=-1), ["bid" + v.TYPE_SUFFIX]),
    "int fraction": (event(volume=1.5), ["volume" + v.TYPE_SUFFIX]),
    "int too large": (event(volume=3_000_000_000), ["volume" + v.TYPE_SUFFIX]),
    "int as float": (event(volume=1200.0, open_interest=3e3), []),
    "int as float below zero": (event(volume=-1200.0), [v.VOLUME_ERROR]),
    "price too large": (event(last_price=1e14, bid=-1e15), ["bid" + v.LIMIT_SUFFIX, "last_price" + v.LIMIT_SUFFIX]),
    "price at its limit": (event(last_price=99_999_999_999_999.0), []),
    "wrong type before too large": (event(ask="x", bid=1e14), ["ask" + v.TYPE_SUFFIX, "bid" + v.LIMIT_SUFFIX]),
    "offset of a day": (event(event_timestamp="2026-10-06T10:20:00-23:59"), []),
    "bool number": (event(ask=True), ["ask" + v.TYPE_SUFFIX]),
    "unchecked nulls": (
        event(event_id=None, symbol=None, contract_symbol=None, delta=None, source=None),
        [],
    ),
    "bad delta": (event(delta="x"), []),
    "extra field": (event(venue={"name": "x}"}), []),
    "not json": ("{bad", [v.MALFORMED]),
    "array": ("[1]", [v.MALFORMED]),
    "scalar": ("5", [v.MALFORMED]),
    "null": ("null", [v.MALFORMED]),
    "single quotes": ("{'event_id': 'a'}", [v.MALFORMED]),
}


@pytest.fixture(scope="module")
def checked(spark):
    """Errors and validity by case, all from one job per result."""
    names = list(CASES)
    frame = events_frame(spark, [row for row, _ in CASES.values()])
    order = lines_frame(spark, [row for row, _ in CASES.values()]).select("value").collect()
    errors = {
        row.value: (row[v.ERRORS], row.ok)
        for row in v.with_validation_errors(frame)
        .withColumn("ok", v.is_valid(frame))
        .select("value", v.ERRORS, "ok")
        .collect()
    }
    return {name: errors[order[i].value.strip()] for i, name in enumerate(names)}


@pytest.mark.parametrize("name", list(CASES))
def test_errors(checked, name):
    errors, ok = checked[name]
    assert errors == CASES[name][1]
    assert ok == (not errors)


def test_text_behind_the_object_is_malformed(spark):
    import json

    whole = json.dumps(event())
    nested = json.dumps(event(tag={"a": "}"}))
    lines = [whole + whole, whole + " x", whole + "," + whole, nested, nested + nested]
    rows = v.with_validation_errors(events_frame(spark, lines)).collect()
    found = {row.value: row[v.ERRORS] for row in rows}
    assert found[nested] == []
    assert [found[line] for line in lines if line != nested] == [[v.MALFORMED]] * 4


def test_nan_and_infinity_are_malformed(spark):
    import json

    lines = [json.dumps(event(bid=float("nan"))), json.dumps(event(bid=float("inf")))]
    rows = v.with_validation_errors(events_frame(spark, lines)).collect()
    assert [row[v.ERRORS] for row in rows] == [[v.MALFORMED]] * 2


def test_duplicate_key_last_wins(spark):
    import json

    line = json.dumps(event())[:-1] + ', "volume": 7}'
    row = events_frame(spark, [line]).first()
    assert row.volume == 7
    assert v.valid_events(events_frame(spark, [line])).count() == 1


def test_blank_lines_are_skipped(spark, tmp_path):
    path = write_lines(tmp_path / "in", ["", "  ", "\t", "  ", event(), " \t" + "{}"])
    lines = read_lines(spark, path)
    assert lines.count() == 2
    assert v.valid_events(read_events(spark, path)).count() == 1


def test_split_covers_every_line(spark):
    frame = events_frame(spark, [row for row, _ in CASES.values()])
    valid, invalid = v.split_events(frame)
    good = sum(not errors for _, errors in CASES.values())
    assert valid.count() == good
    assert invalid.count() == len(CASES) - good
    assert invalid.filter(F.size(v.ERRORS) == 0).count() == 0


def test_columnar_input_reads_null_as_missing(spark):
    rows = [event(), event(symbol=None), event(delta=None, volume=-1), event(volume=-1)]
    frame = spark.createDataFrame(
        [tuple(float(x) if isinstance(x, int) and n not in ("volume", "open_interest") else x
               for n, x in row.items()) for row in rows],
        RAW_SCHEMA,
    )
    found = [row[v.ERRORS] for row in v.with_validation_errors(frame).collect()]
    assert found == [
        [],
        [v.MISSING_PREFIX + "symbol"],
        [v.MISSING_PREFIX + "delta"],
        [v.VOLUME_ERROR],
    ]
    assert v.valid_events(frame).count() == 1


def test_fail_fast_ends_the_job(spark):
    lines = strip_lines(lines_frame(spark, [event(), "{bad"]))
    with pytest.raises(PySparkException):
        parse_events(lines, fail_fast=True).collect()
    assert parse_events(strip_lines(lines_frame(spark, [event()])), fail_fast=True).count() == 1
