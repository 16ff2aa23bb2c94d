"""Compaction in generations: only what is new, failed attempts, expiry, order."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.session import Files
from tidemark.streaming import append_sink
from tidemark.streaming.append_sink import AppendSink, compact_new, compacted, expire


def write(spark, root, batch_id, rows, **options):
    sink = AppendSink(root, F.col("p"), F.col("v"), order=[F.col("id")], **options)
    frame = spark.createDataFrame(rows, "id long, p string, v string")
    assert sink.write_batch(frame, batch_id)


def texts(spark, target):
    rows = sorted((r.out_path, r.line, r.value) for r in compacted(spark, target).collect())
    found = {}
    for path, line, value in rows:
        assert line == len(found.setdefault(path, []))
        found[path].append(value)
    return found


def test_second_run_reads_new_batches_only(spark, folder):
    root, target = f"{folder}/sink", f"{folder}/out"
    write(spark, root, 0, [(2, "a", "a2"), (1, "a", "a1"), (3, "b/c", "x")])
    write(spark, root, 1, [(1, "a", "a3"), (2, "a", None)])
    assert compact_new(spark, root, target) == [0]
    assert compact_new(spark, root, target) == []
    Files(spark, root).delete(f"{root}/data/batch_id=0")
    write(spark, root, 2, [(9, "a", ""), (10, "b/c", "y")])
    write(spark, root, 3, [(9, None, "lost")])
    assert compact_new(spark, root, target) == [2]
    assert texts(spark, target) == {"a": ["a1", "a2", "a3", ""], "b/c": ["x", "y"]}


def test_nothing_yet_and_batches_without_rows(spark, folder):
    root, target = f"{folder}/sink", f"{folder}/out"
    assert compact_new(spark, root, target) == []
    assert compacted(spark, target).columns == ["generation", "out_path", "line", "value"]
    write(spark, root, 0, [(1, None, "v")])
    assert compact_new(spark, root, target) == [0]
    assert texts(spark, target) == {}


def test_large_path_is_several_files_in_order(spark, folder):
    root, target = f"{folder}/sink", f"{folder}/out"
    for batch in range(2):
        write(spark, root, batch, [(i, "a", f"{batch}-{i:04}") for i in range(400)])
    compact_new(spark, root, target, file_bytes=1000)
    assert len(Files(spark, target).names(f"{target}/data/generation=0/out_path=a")) > 3
    assert texts(spark, target) == {"a": [f"{batch}-{i:04}" for batch in range(2) for i in range(400)]}


def test_failed_attempt_is_not_shown_and_written_again(spark, folder, monkeypatch):
    root, target = f"{folder}/sink", f"{folder}/out"
    write(spark, root, 0, [(1, "a", "one")])

    def fails(*_):
        raise ConnectionError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(append_sink, "_switch", fails)
        with pytest.raises(ConnectionError):
            compact_new(spark, root, target)
    assert texts(spark, target) == {}
    write(spark, root, 1, [(1, "a", "two")])
    assert compact_new(spark, root, target) == [0]
    assert texts(spark, target) == {"a": ["one", "two"]}


def test_expiry_covers_generations_and_keeps_the_mark(spark, folder):
    root, target = f"{folder}/sink", f"{folder}/out"
    for batch, hour in enumerate([0, 10, 29]):
        now = datetime(2024, 1, 1 + hour // 24, hour % 24, tzinfo=UTC)
        write(spark, root, batch, [(1, "a", str(batch))], expiry="1.00:00:00", clock=lambda now=now: now)
    assert compact_new(spark, root, target) == [0, 2]
    assert expire(spark, root, datetime(2024, 1, 2, 9, tzinfo=UTC), target) == [0]
    assert texts(spark, target) == {"a": ["0", "1", "2"]}
    assert expire(spark, root, datetime(2024, 1, 2, 10, tzinfo=UTC), target) == [1]
    assert texts(spark, target) == {"a": ["2"]}
    assert expire(spark, root, datetime(2024, 1, 4, tzinfo=UTC), target) == [2]
    assert texts(spark, target) == {}
    write(spark, root, 3, [(1, "a", "3")])
    assert compact_new(spark, root, target) == [3]
    assert texts(spark, target) == {"a": ["3"]}
