"""Rows and files that several test modules build."""

from __future__ import annotations

import json

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def event(**changes) -> dict:
    """A valid event with some fields changed; a value of `...` removes the field."""
    row = {
        "event_id": "evt_a",
        "symbol": "ORBT",
        "contract_symbol": "ORBT_20261218_00084000_P",
        "expiration_date": "2026-12-18",
        "strike": 84.0,
        "option_type": "PUT",
        "bid": 1.9,
        "ask": 2.15,
        "last_price": 2.05,
        "volume": 640,
        "open_interest": 15500,
        "implied_volatility": 0.312,
        "delta": -0.38,
        "underlying_price": 86.75,
        "event_timestamp": "2026-10-06T10:20:00",
        "source": "venue_a",
    }
    row.update(changes)
    return {name: value for name, value in row.items() if value is not ...}


def write_lines(path, lines) -> str:
    path.mkdir(parents=True, exist_ok=True)
    texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    (path / "part.jsonl").write_text("\n".join(texts) + "\n", encoding="utf-8")
    return str(path)


def lines_frame(spark, lines):
    texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    return spark.createDataFrame([(text,) for text in texts], "value string")


def events_frame(spark, rows):
    """Parsed raw events from dicts or raw lines."""
    from tapewatch.sources.jsonl import parse_events, strip_lines

    return parse_events(strip_lines(lines_frame(spark, rows)))
