"""Readers, history, the batch read and the streaming source."""

import bz2
import gzip
import json
import os

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.sources import (
    History,
    LogEntry,
    LogReader,
    ManifestReader,
    history_table,
    only_new,
    read_batch_log,
    read_manifest,
    register,
    sets_differ,
    write_manifest,
)
from tidemark.sources.readers import lines_of_range
from tidemark.sources.stream import BatchLogStream, find_reader
from tidemark.streaming.running import into_table, run_available, run_once, run_steps

MANIFEST = (
    "offset long, name string, cti timestamp, partitions int, "
    "is_snapshot boolean, is_ready boolean, path string"
)


def put(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write("".join(line + "\n" for line in lines))


@pytest.fixture
def log(spark, folder):
    """Three steps of two tables: the second step changes one of them only."""
    put(f"{folder}/a/0/part=0/x.txt", "a0-0", "a0-1")
    put(f"{folder}/a/0/part=1/x.txt", "a0-2")
    put(f"{folder}/b/0/x.txt", "b0-0")
    put(f"{folder}/b/1/x.txt", "b1-0", "b1-1")
    put(f"{folder}/a/2/x.txt", "a2-0")
    rows = [
        (0, "a", "2024-01-01", 2, True, True, f"{folder}/a/0"),
        (0, "b", "2024-01-01", 1, False, True, f"{folder}/b/0"),
        (1, "a", "2024-01-01", 2, True, True, f"{folder}/a/0"),
        (1, "b", "2024-01-02", 1, False, True, f"{folder}/b/1"),
        (2, "a", "2024-01-03", 1, False, False, f"{folder}/a/2"),
        (2, "b", "2024-01-02", 1, False, True, f"{folder}/b/1"),
    ]
    texts = spark.createDataFrame(rows, MANIFEST.replace("cti timestamp", "cti string"))
    manifest = texts.withColumn("cti", F.col("cti").cast("timestamp"))
    write_manifest(manifest, f"{folder}/manifest")
    return read_manifest(spark, f"{folder}/manifest")


def values(rows):
    return sorted(row.value for row in rows.collect())


def stream(spark, folder, **options):
    register(spark)
    options = {"reader": "MANIFEST", "historyPath": f"{folder}/history", **options}
    return (
        spark.readStream.format("batchlog")
        .option("manifestPath", f"{folder}/manifest")
        .options(**options)
        .load()
    )


def test_batch_ranges(spark, log):
    every = ["a0-0", "a0-0", "a0-1", "a0-1", "a0-2", "a0-2", "b0-0", "b1-0", "b1-0", "b1-1", "b1-1"]
    assert values(read_batch_log(spark, log)) == every
    assert values(read_batch_log(spark, log, start=1)) == ["b1-0", "b1-1"]
    assert values(read_batch_log(spark, log, start=0, end=1)) == [
        "a0-0", "a0-1", "a0-2", "b1-0", "b1-1",
    ]
    assert values(read_batch_log(spark, log, start=2)) == []
    assert values(read_batch_log(spark, log, emit="new")) == [
        "a0-0", "a0-1", "a0-2", "b0-0", "b1-0", "b1-1",
    ]


def test_stamps_and_partitions(spark, log):
    rows = read_batch_log(spark, log, end=0, with_partition=True)
    got = {(r.value, r.ms, r.partition) for r in rows.withColumn("ms", F.unix_millis("cti")).collect()}
    assert got == {
        ("a0-0", 0, 0), ("a0-1", 0, 0), ("a0-2", 0, 1), ("b0-0", 1704067200000, None),
    }


def test_missing_steps_fail(spark, log):
    with pytest.raises(ValueError, match="lacks"):
        read_batch_log(spark, log.filter("offset <> 1"))
    with pytest.raises(ValueError, match="lacks"):
        read_batch_log(spark, log, end=3)
    with pytest.raises(ValueError, match="lacks"):
        read_batch_log(spark, log.filter("offset > 0"))
    with pytest.raises(ValueError, match="emit"):
        read_batch_log(spark, log, emit="all")


def test_batch_plan_scans_ready_folders_once_without_shuffle(spark, log):
    rows = read_batch_log(spark, log)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan
    assert plan.count("FileScan text") == 1
    files = {os.path.basename(os.path.dirname(f)) for f in rows.inputFiles()}
    assert "2" not in files


def test_sets(spark, log):
    step = [log.filter(F.col("offset") == i) for i in range(3)]
    assert sets_differ(step[0], step[0]).count() == 0
    assert {r.side for r in sets_differ(step[0], step[1]).collect()} == {"left", "right"}
    assert only_new(log).count() == 4


def test_stream_steps_and_restart(spark, log, folder):
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    run_once(into_table(stream(spark, folder), out), checkpoint)
    assert values(spark.read.parquet(out)) == ["a0-0", "a0-1", "a0-2", "b0-0"]
    # A new process continues behind the last step; nothing comes twice.
    run_steps(into_table(stream(spark, folder), out), checkpoint)
    assert values(spark.read.parquet(out)) == values(read_batch_log(spark, log))
    assert History(f"{folder}/history").offsets() == [0, 1, 2]
    rows = history_table(spark, f"{folder}/history")
    assert rows.count() == 6
    run_steps(into_table(stream(spark, folder), out), checkpoint)
    assert values(spark.read.parquet(out)) == values(read_batch_log(spark, log))


def test_stream_emits_new_entries_only(spark, log, folder):
    out = f"{folder}/out"
    run_steps(into_table(stream(spark, folder, emit="new"), out), f"{folder}/checkpoint")
    assert values(spark.read.parquet(out)) == values(read_batch_log(spark, log, emit="new"))


def test_stream_cuts_files(spark, log, folder):
    out = f"{folder}/out"
    run_steps(into_table(stream(spark, folder, splitBytes="3"), out), f"{folder}/checkpoint")
    assert values(spark.read.parquet(out)) == values(read_batch_log(spark, log))


def test_stream_without_entries_waits(spark, folder):
    os.makedirs(f"{folder}/manifest")
    out = f"{folder}/out"
    run_available(into_table(stream(spark, folder), out), f"{folder}/checkpoint")
    assert spark.read.parquet(out).count() == 0
    assert History(f"{folder}/history").offsets() == []


def test_lost_history_is_an_error(spark, log, folder):
    run_once(into_table(stream(spark, folder), f"{folder}/out"), f"{folder}/checkpoint")
    history = History(f"{folder}/history")
    history.write(1, [])
    history.write(2, [])
    os.remove(f"{folder}/history/1")
    with pytest.raises(Exception, match="no history for offset 1"):
        run_steps(into_table(stream(spark, folder), f"{folder}/out"), f"{folder}/checkpoint")


class CountingReader(LogReader):
    """Steps through the numbers up to ``last``, two lines each."""

    short_name = "Counting"

    def configure(self, options):
        self.last = int(options["LAST"])
        self.seen = options["seen"]

    def initial(self):
        return [LogEntry("numbers", 0, partitions=2)]

    def next_entry(self, entry):
        ms = min(entry.cti_ms + 1, self.last)
        return LogEntry("numbers", ms, partitions=2)

    def read(self, entry, partition, split):
        yield pa.array([f"{entry.cti_ms}-{partition}"])

    def acknowledge(self, entry):
        with open(f"{self.seen}/acknowledged-{entry.cti_ms}", "w"):
            pass


def test_own_reader(spark, folder):
    register(spark, CountingReader)
    rows = (
        spark.readStream.format("batchlog")
        .options(reader="counting", historyPath=f"{folder}/history", last=3, seen=folder, minLogs=1)
        .load()
    )
    run_steps(into_table(rows, f"{folder}/out"), f"{folder}/checkpoint")
    got = values(spark.read.parquet(f"{folder}/out"))
    assert got == [f"{n}-{p}" for n in range(4) for p in range(2)]
    assert os.path.exists(f"{folder}/acknowledged-2")
    assert History(f"{folder}/history").offsets() == [1, 2, 3]


class StumblingReader(CountingReader):
    """Fails at its first acknowledgement of the number 2."""

    short_name = "Stumbling"

    def acknowledge(self, entry):
        with open(f"{self.seen}/calls", "a") as file:
            file.write(f"{entry.cti_ms}\n")
        if entry.cti_ms == 2 and open(f"{self.seen}/calls").read().split().count("2") == 1:
            raise OSError("acknowledged by half")


def test_every_step_is_acknowledged_across_restarts(spark, folder):
    register(spark, StumblingReader)

    def run(last):
        rows = (
            spark.readStream.format("batchlog")
            .options(reader="stumbling", historyPath=f"{folder}/history", last=last, seen=folder)
            .options(stepsPerBatch=3, minLogs=1)
            .load()
        )
        run_steps(into_table(rows, f"{folder}/out"), f"{folder}/checkpoint")

    def calls():
        return [int(line) for line in open(f"{folder}/calls").read().split()]

    history = History(f"{folder}/history")
    run(2)
    assert not os.path.exists(f"{folder}/calls") and history.acknowledged() == -1
    with pytest.raises(Exception, match="by half"):
        run(7)
    # The step that was cut short is still in the queue, and nothing before it.
    assert calls() == [0, 1, 2] and history.acknowledged() == 1
    run(7)
    assert calls()[:4] == [0, 1, 2, 2] and sorted(set(calls())) == calls()[:3] + calls()[4:]
    assert set(calls()) >= set(range(6)) and history.acknowledged() == max(calls())
    got = values(spark.read.parquet(f"{folder}/out"))
    assert got == [f"{n}-{p}" for n in range(8) for p in range(2)]


def test_history_without_mark_waits_from_its_oldest_offset(folder):
    history = History(f"{folder}/h")
    assert list(history.waiting(-1)) == []
    for offset in (4, 5, 6):
        history.write(offset, [])
    assert list(history.waiting(5)) == [4, 5]
    history.acknowledge(4)
    assert list(history.waiting(6)) == [5, 6] and history.offsets() == [4, 5, 6]


def test_compressed_files_and_bytes_that_are_no_text(spark, folder):
    plain = b"a\xff\xfe\n\nb\xc3\xa9\r\nlast"
    packed = b"c\n" * 3 + b"\x80\n" + b"no end"
    os.makedirs(f"{folder}/t/0/part=0")
    os.makedirs(f"{folder}/t/0/part=1")
    files = {"part=0/x.txt": plain, "part=0/empty.txt": b"", "part=1/y.gz": gzip.compress(packed) + gzip.compress(b"\nmore\n")}
    files["z.bz2"] = bz2.compress(packed)
    for name, data in files.items():
        with open(f"{folder}/t/0/{name}", "wb") as file:
            file.write(data)
    rows = [(0, "t", 5, 2, False, True, f"{folder}/t/0")]
    manifest = spark.createDataFrame(rows, MANIFEST.replace("cti timestamp", "cti_ms long"))
    manifest = manifest.withColumn("cti", F.timestamp_millis("cti_ms"))
    write_manifest(manifest, f"{folder}/manifest")
    out = f"{folder}/out"
    run_steps(into_table(stream(spark, folder, splitBytes="4"), out), f"{folder}/checkpoint")
    forms = [read_batch_log(spark, manifest), spark.read.parquet(out)]
    got = [sorted(r[0] for r in rows.select(F.hex(F.col("value").cast("binary"))).collect()) for rows in forms]
    want = plain.split(b"\n") + (packed + b"\nmore").split(b"\n") + packed.split(b"\n")
    assert got[0] == got[1] == sorted(line.hex().upper() for line in want)


def test_unknown_compression_is_an_error(folder):
    put(f"{folder}/t/x.zst", "a")
    reader = ManifestReader()
    reader.configure({"manifestPath": folder})
    entry = LogEntry("t", 0, path=f"{folder}/t")
    with pytest.raises(ValueError, match="content=entries"):
        list(reader.read(entry, 0, reader.splits(entry, 0)[0]))


def test_small_files_share_a_task(folder):
    for i in range(50):
        put(f"{folder}/t/{i}.txt", "x")
    put(f"{folder}/t/large.txt", "y" * 1000)
    reader = ManifestReader()
    reader.configure({"manifestPath": folder, "splitBytes": 64 << 20})
    history = History(f"{folder}/h")
    history.write(0, [LogEntry("t", 0, path=f"{folder}/t")])
    source = BatchLogStream(reader, f"{folder}/h", {"emit": "set", "content": "lines"})
    tasks = source.partitions({"v": -1}, {"v": 0})
    assert [len(task.pieces) for task in tasks] == [15, 15, 15, 6]
    lines = [line for task in tasks for batch in source.read(task) for line in batch.column("value").to_pylist()]
    assert sorted(lines) == ["x"] * 50 + ["y" * 1000]


def test_manifest_reads_new_files_only(spark, folder, monkeypatch):
    def write(step):
        record = {"offset": step, "name": "t", "cti_ms": step, "path": "/x"}
        put(f"{folder}/m/{step}.json", json.dumps(record))

    write(0)
    reader = ManifestReader()
    reader.configure({"manifestPath": f"{folder}/m"})
    seen = []
    whole = ManifestReader._entries_of
    monkeypatch.setattr(reader, "_entries_of", lambda fs, path: seen.append(os.path.basename(path)) or whole(fs, path))
    first = reader.initial()
    write(1)
    assert reader.next_set(first)[0].step == 1
    assert seen == ["0.json", "1.json"]


def test_reader_lookup():
    class Twin(ManifestReader):
        short_name = "Manifest"

    assert find_reader("maniFEST", [ManifestReader]) is ManifestReader
    with pytest.raises(ValueError, match="missing.*manifest"):
        find_reader(None, [ManifestReader])
    with pytest.raises(ValueError, match="0 readers"):
        find_reader("other", [ManifestReader])
    with pytest.raises(ValueError, match="2 readers"):
        find_reader("manifest", [ManifestReader, Twin])


@pytest.mark.parametrize(
    "options, text",
    [
        ({"reader": ""}, "option reader is missing"),
        ({"historyPath": ""}, "historyPath"),
        ({"emit": "some"}, "emit"),
        ({"minLogs": "0"}, "minLogs"),
        ({"content": "pages"}, "content"),
    ],
)
def test_bad_options(spark, folder, options, text):
    with pytest.raises(Exception, match=text):
        rows = stream(spark, folder, **options)
        run_steps(into_table(rows, f"{folder}/out"), f"{folder}/checkpoint")


def test_history_files(folder):
    history = History(f"{folder}/h")
    assert history.newest() == -1
    entries = [LogEntry("t", 5, 3, True, False, "/x", step=7)]
    history.write(0, entries)
    assert history.read(0) == entries and history.read(0)[0].step == 7
    with pytest.raises(ValueError, match="another stream"):
        history.write(0, entries)
    with pytest.raises(ValueError, match="no history"):
        history.read(1)
    put(f"{folder}/h/2", "v2", "{}")
    with pytest.raises(ValueError, match="version"):
        history.read(2)
    open(f"{folder}/h/3", "w").close()
    with pytest.raises(ValueError, match="empty"):
        history.read(3)


def test_history_table_checks_version(spark, folder):
    put(f"{folder}/h/0", "v2", LogEntry("t", 5).to_line())
    with pytest.raises(Exception, match="bad history line"):
        history_table(spark, f"{folder}/h").collect()


def test_manifest_reader_passes_over_repeated_sets(spark, folder):
    rows = [(i, "t", 0 if i < 2 else 1, 1, False, True, "/x") for i in range(3)]
    schema = MANIFEST.replace("cti timestamp", "cti_ms long")
    manifest = spark.createDataFrame(rows, schema).withColumn("cti", F.timestamp_millis("cti_ms"))
    write_manifest(manifest, f"{folder}/m")
    reader = ManifestReader()
    reader.configure({"manifestPath": f"{folder}/m"})
    first = reader.initial()
    second = reader.next_set(first)
    assert (first[0].step, second[0].step) == (0, 2)
    assert reader.next_set(second) == second
    assert reader.next_entry(first[0]).cti_ms == 1


@hypothesis_settings(max_examples=60, deadline=None)
@given(
    lines=st.lists(st.text(alphabet="abé ", max_size=6), min_size=1, max_size=12),
    step=st.integers(1, 9),
    ended=st.booleans(),
)
def test_ranges_give_each_line_once(tmp_path_factory, lines, step, ended):
    data = ("\n".join(lines) + ("\n" if ended else "")).encode()
    path = str(tmp_path_factory.mktemp("range") / "f.txt")
    with open(path, "wb") as file:
        file.write(data)
    got = []
    for start in range(0, len(data), step):
        for array in lines_of_range(path, start, min(step, len(data) - start)):
            got += array.to_pylist()
    want = data.decode().split("\n")
    if want[-1] == "":
        want.pop()
    assert got == want
