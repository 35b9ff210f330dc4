"""Jobs that replace earlier output do so in a session whose overwrites are dynamic as well."""

from __future__ import annotations

import pytest
from helpers import event, write_lines

from tapewatch.plans import batch, warehouse
from tapewatch.streaming import compaction, consumer

MODE = "spark.sql.sources.partitionOverwriteMode"


@pytest.fixture(params=["static", "dynamic"])
def session(spark, request):
    spark.conf.set(MODE, request.param)
    yield spark
    spark.conf.unset(MODE)


def test_batch_leaves_no_route_of_an_earlier_run(session, tmp_path):
    mixed = write_lines(tmp_path / "mixed", [event(event_id="a"), "{bad"])
    clean = write_lines(tmp_path / "clean", [event(event_id="b")])
    out = str(tmp_path / "out")
    batch.run_batch(session, mixed, out)
    batch.run_batch(session, clean, out)
    assert [row.event_id for row in batch.read_valid(session, out).collect()] == ["b"]
    assert batch.read_invalid(session, out).collect() == []


def test_reset_forgets_earlier_loads(session, tmp_path):
    layers = []
    for name, changes in {"first": {"event_id": "a", "symbol": "KELP"}, "second": {"event_id": "b"}}.items():
        path = write_lines(tmp_path / name, [event(volume=9000, **changes)])
        batch.run_batch(session, path, str(tmp_path / f"{name}-layer"))
        layers.append(batch.read_valid(session, str(tmp_path / f"{name}-layer"), with_order=True))
    root = str(tmp_path / "tables")
    warehouse.load_warehouse(layers[0], root)
    warehouse.load_warehouse(layers[1], root, reset=True)
    tables = warehouse.Warehouse(session, root).tables()
    assert [row.event_id for row in tables["fact_options_event"].collect()] == ["b"]
    assert [row.symbol for row in tables["dim_symbol"].collect()] == ["ORBT"]
    assert {row.event_id for row in tables["fact_unusual_activity"].collect()} == {"b"}


def test_retried_batch_replaces_its_folder(session, tmp_path):
    """What an attempt that died left in a route that the retry does not write goes as well."""
    out = f"{tmp_path}/out"
    left = session.createDataFrame([("left", "invalid"), ("too", "alert")], "value string, route string")
    left.write.partitionBy("route").text(f"{out}/batch_id=0")
    source = write_lines(tmp_path / "in", [event(event_id="a", volume=9000)])
    consumer.start_consumer(session, source, out, f"{tmp_path}/checkpoint").awaitTermination()
    assert [row.event_id for row in consumer.read_alerts(session, out).collect()] == ["a"]
    assert compaction.read_output(session, out, consumer.INVALID).collect() == []
