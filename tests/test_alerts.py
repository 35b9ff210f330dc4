from __future__ import annotations

import json
import os

import pytest
from helpers import SMALL, event, lines_frame, write_lines
from pyspark.sql import functions as F

from tapewatch.operators.enrich import process
from tapewatch.schema import ENRICHED_FIELDS
from tapewatch.sources.jsonl import read_lines
from tapewatch.sources.market_events import options_events, options_lines
from tapewatch.streaming import alerts
from tapewatch.streaming.consumer import read_stream


def alert(name, minute=0, hour=10, **changes):
    return event(event_id=name, volume=9000, event_timestamp=f"2026-10-06T{hour:02d}:{minute:02d}:00", **changes)


def run(spark, root, delay="1 hour", max_files=1):
    query = alerts.start_alerts(
        read_stream(spark, f"{root}/in", max_files), f"{root}/out", f"{root}/check", delay=delay
    )
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def deliver(root, name, rows):
    """A file that is moved into place whole, later than those before it."""
    (root / "in").mkdir(exist_ok=True)
    text = "\n".join(row if isinstance(row, str) else json.dumps(row) for row in rows) + "\n"
    (root / name).write_text(text)
    # a second apart: the stream takes files by their time, and two written in one millisecond in any order
    moment = 1_790_000_000 + len(list((root / "in").iterdir()))
    os.utime(root / name, (moment, moment))
    (root / name).rename(root / "in" / name)


def sent(spark, root):
    return sorted(str(row.event_id) for row in alerts.read_alerts(spark, f"{root}/out").collect())


def test_an_alert_in_two_files_and_after_a_restart_leaves_once(spark, tmp_path):
    deliver(tmp_path, "a", [alert("x"), alert("x"), alert("y", 5), event(event_id="normal"), "{bad"])
    deliver(tmp_path, "b", [alert("x"), alert("z", 10)])
    run(spark, tmp_path)
    assert sent(spark, tmp_path) == ["x", "y", "z"]
    deliver(tmp_path, "c", [alert("y", 5), alert("x", 1), alert("w", 20)])
    run(spark, tmp_path)
    assert sent(spark, tmp_path) == ["w", "x", "y", "z"]
    run(spark, tmp_path)
    assert sent(spark, tmp_path) == ["w", "x", "y", "z"]


def test_late_alerts_do_not_leave_and_are_found(spark, tmp_path):
    deliver(tmp_path, "a", [alert("new", 0, 15)])
    deliver(tmp_path, "b", [alert("in time", 30, 14), alert("new", 0, 15)])
    deliver(tmp_path, "c", [alert("also in time", 1, 14), alert("late", 0, 13), alert("new", 0, 15)])
    query = run(spark, tmp_path)
    assert sent(spark, tmp_path) == ["also in time", "in time", "new"]
    assert alerts.dropped_as_late(query) == 1
    came = alerts.alert_lines(read_lines(spark, f"{tmp_path}/in"))
    late = alerts.late_alerts(came, spark, f"{tmp_path}/out").collect()
    assert [row.event_id for row in late] == ["late"]


def test_state_is_bounded_by_the_delay(spark, tmp_path):
    """Ids are forgotten once the watermark has passed them; a repeat after that is late."""
    for hour in range(2, 12):
        deliver(tmp_path, f"f{hour:02d}", [alert(f"{hour}-{i}", i, hour) for i in range(20)])
    query = run(spark, tmp_path, delay="90 minutes")
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(sent(spark, tmp_path)) == 200
    # a batch of 20 an hour, kept for 90 minutes behind the latest time and as long again
    assert max(rows) <= 20 * 5 and rows[-1] <= 20 * 4
    deliver(tmp_path, "f99", [alert("2-0", 0, 2)])
    run(spark, tmp_path, delay="90 minutes")
    assert len(sent(spark, tmp_path)) == 200


def test_alerts_without_an_id_are_told_apart_by_their_lines(spark, tmp_path):
    one, two = alert(None, last_price=1.0), alert(None, last_price=2.0)
    deliver(tmp_path, "a", [one, two, one])
    deliver(tmp_path, "b", [two])
    run(spark, tmp_path)
    assert sent(spark, tmp_path) == ["None", "None"]


def test_batch_form_keeps_the_first_of_the_input(spark, tmp_path):
    rows = [alert("x", 30, last_price=1.0), alert("x", 10, last_price=2.0), alert("y")]
    path = write_lines(tmp_path / "in", rows)
    ordered = alerts.distinct_alerts(alerts.alert_lines(read_lines(spark, path, with_order=True)))
    prices = {r.event_id: json.loads(r.value)["last_price"] for r in ordered.collect()}
    assert prices == {"x": 1.0, "y": 2.05}
    by_time = alerts.distinct_alerts(alerts.alert_lines(lines_frame(spark, rows)))
    assert {r.event_id: json.loads(r.value)["last_price"] for r in by_time.collect()}["x"] == 2.0
    assert alerts.distinct_alerts(alerts.alert_lines(lines_frame(spark, ["", "{bad"]))).collect() == []


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_instants_do_not_depend_on_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2026-03-08T02:30:00", "2026-11-01T01:30:00.25", "2026-05-29T13:45:00+05:30"]
        frame = spark.createDataFrame([(text,) for text in texts], "t string")
        found = [row[0] for row in frame.select(F.unix_micros(alerts.event_instant(F.col("t")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [1772937000000000, 1793496600250000, 1780042500000000]


def test_a_replayed_table_equals_its_batch_form(spark, tmp_path):
    lines = options_lines(spark, SMALL)
    lines.repartition(3).write.text(f"{tmp_path}/in")
    lines.repartition(2).write.mode("append").text(f"{tmp_path}/in")
    run(spark, tmp_path, delay="400 days", max_files=2)
    found = alerts.read_alerts(spark, f"{tmp_path}/out")
    expected = process(options_events(spark, SMALL)).filter("unusual_activity_score > 0")
    assert found.count() == 416
    assert found.exceptAll(expected.select(*ENRICHED_FIELDS)).isEmpty()
