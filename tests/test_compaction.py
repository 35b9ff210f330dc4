from __future__ import annotations

import json
import os

import pytest
from helpers import SMALL, event, write_lines
from pyspark.errors import StreamingQueryException

from tapewatch.sources.market_events import options_lines
from tapewatch.streaming import compaction, consumer
from tapewatch.streaming.compaction import Part, compact, outgrown, remove_compacted


def consume(spark, root, **options):
    run = consumer.start_consumer(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", log=True, **options)
    run.awaitTermination()


def contents(spark, root):
    """All rows of all routes, each route sorted."""
    out = f"{root}/out"
    readers = [consumer.read_alerts, consumer.read_quarantine, consumer.read_log]
    return [sorted(map(repr, read(spark, out).collect())) for read in readers]


def data_files(root):
    return [
        f"{folder}/{name}" for folder, _, names in os.walk(f"{root}/out") for name in names if name.startswith("part-")
    ]


def generations(spark, root):
    output = compaction._Output(spark, f"{root}/out")
    return output.generations(output.log.state())


@pytest.fixture()
def stream(spark, tmp_path):
    """Seven batches of two files each."""
    options_lines(spark, SMALL).repartition(14).write.text(str(tmp_path / "in"))
    consume(spark, tmp_path, max_files_per_trigger=2)
    return str(tmp_path)


def test_same_rows_before_during_and_after(spark, stream):
    before = contents(spark, stream)
    assert [len(rows) for rows in before] == [416, 137, 1000]
    opened = [read(spark, f"{stream}/out") for read in (consumer.read_alerts, consumer.read_quarantine)]

    made = compact(spark, f"{stream}/out")
    assert (made.first, made.last) == (0, 5)
    assert contents(spark, stream) == before
    # the batches are still there for readers that began earlier, and no longer afterwards
    assert remove_compacted(spark, f"{stream}/out", older_than_hours=1) == []
    assert [frame.count() for frame in opened] == [416, 137]
    assert len(remove_compacted(spark, f"{stream}/out", older_than_hours=0)) == 6
    assert contents(spark, stream) == before
    assert compact(spark, f"{stream}/out") is None


def test_stream_goes_on_after_compaction(spark, stream):
    compact(spark, f"{stream}/out")
    remove_compacted(spark, f"{stream}/out", older_than_hours=0)
    write_lines_later(stream, "late", [event(event_id="late", volume=9000), "{bad"])
    consume(spark, stream)
    assert [len(rows) for rows in contents(spark, stream)] == [417, 138, 1002]
    made = compact(spark, f"{stream}/out", min_batches=1)
    assert (made.first, made.last) == (6, 6)
    assert [len(rows) for rows in contents(spark, stream)] == [417, 138, 1002]


def write_lines_later(root, name, rows):
    texts = [row if isinstance(row, str) else json.dumps(row) for row in rows]
    hidden = f"{root}/{name}"
    with open(hidden, "w") as file:
        file.write("\n".join(texts) + "\n")
    os.rename(hidden, f"{root}/in/{name}.jsonl")


def test_last_batch_is_left_to_a_retry(spark, tmp_path):
    """A folder of a batch that was not committed is written again, so it is not compacted."""
    write_lines(tmp_path / "in", [event(event_id="a", volume=9000)])
    consume(spark, tmp_path)
    assert compact(spark, f"{tmp_path}/out", min_batches=1) is None
    assert [len(rows) for rows in contents(spark, tmp_path)] == [1, 0, 1]


def test_killed_run_leaves_nothing_visible(spark, stream, monkeypatch):
    before = contents(spark, stream)

    def dies(self, state, **change):
        raise RuntimeError("lost")

    monkeypatch.setattr(compaction.CommitLog, "append", dies)
    with pytest.raises(RuntimeError):
        compact(spark, f"{stream}/out")
    monkeypatch.undo()
    assert contents(spark, stream) == before
    assert generations(spark, stream) == []
    assert compact(spark, f"{stream}/out").last == 5
    removed = remove_compacted(spark, f"{stream}/out", older_than_hours=0)
    # six batches and the folder of the run that died
    assert len(removed) == 7
    assert contents(spark, stream) == before


def test_second_of_two_runs_gives_way(spark, stream, monkeypatch):
    before = contents(spark, stream)
    append = compaction.CommitLog.append

    def overtaken(self, state, **change):
        monkeypatch.undo()
        assert compact(spark, f"{stream}/out").last == 5
        return append(self, state, **change)

    monkeypatch.setattr(compaction.CommitLog, "append", overtaken)
    assert compact(spark, f"{stream}/out") is None
    assert len(generations(spark, stream)) == 1
    assert contents(spark, stream) == before


def test_new_checkpoint_on_a_compacted_output_stops(spark, stream):
    compact(spark, f"{stream}/out")
    run = consumer.start_consumer(spark, f"{stream}/in", f"{stream}/out", f"{stream}/other")
    with pytest.raises(StreamingQueryException, match="compacted"):
        run.awaitTermination()
    assert [len(rows) for rows in contents(spark, stream)] == [416, 137, 1000]


def test_number_of_files_is_bounded(spark, tmp_path):
    """Compacted after every batch, the output keeps a few files for each route."""
    (tmp_path / "in").mkdir()
    for number in range(6):
        write_lines_later(tmp_path, f"n{number}", [event(event_id=f"a{number}", volume=9000), "{bad", event()])
        consume(spark, tmp_path)
        compact(spark, f"{tmp_path}/out", min_batches=1)
        remove_compacted(spark, f"{tmp_path}/out", older_than_hours=0)
    assert [len(rows) for rows in contents(spark, tmp_path)] == [6, 6, 18]
    found = generations(spark, tmp_path)
    assert [part.first for part in found[1:]] == [part.last + 1 for part in found[:-1]]
    assert found[-1].last == 4
    assert all(one.bytes > 2 * after.bytes for one, after in zip(found, found[1:]))
    assert len(data_files(tmp_path)) <= 3 * (len(found) + 1)


def test_large_routes_get_several_files(spark, stream):
    before = contents(spark, stream)
    whole = sum(os.path.getsize(path) for path in data_files(stream) if "/batch_id=6/" not in path)
    made = compact(spark, f"{stream}/out", file_bytes=whole // 8)
    files = [path for path in data_files(stream) if path.startswith(made.folder)]
    assert 8 <= len(files) <= 11
    assert contents(spark, stream) == before


@pytest.mark.parametrize("settled", [1 << 20, 1 << 62])
def test_sizes_fall_by_half(settled):
    """Many rounds of batches of odd sizes: few generations, and few copies of a byte."""
    listed, copied, total = [], 0, 0
    for number in range(3000):
        size = (number * 7919) % 1000
        packed = outgrown(listed, size, settled)
        whole = size + sum(part.bytes for part in packed)
        first = packed[0].first if packed else number
        listed = listed[: len(listed) - len(packed)] + [Part(first, number, "", whole)]
        copied, total = copied + whole, total + size
        open_ones = [part for part in listed if part.bytes < settled]
        assert all(one.bytes > 2 * after.bytes for one, after in zip(open_ones, open_ones[1:]))
        assert len(listed) <= 21 + total // settled
    assert listed[0].first == 0
    assert copied < 20 * total
