"""The ``batchlog`` streaming source.

    register(spark, MyReader)
    spark.readStream.format("batchlog").option("reader", "manifest")...

Options: ``reader`` (name, any case), ``historyPath`` (shared folder), ``emit``
(``set`` or ``new``), ``minLogs`` (offsets kept, 128), ``stepsPerBatch`` (1), ``content``
(``lines`` or ``entries``), and whatever the reader itself needs.

Every entry of every step is acknowledged at least once and in order, also where a batch
covers several steps or the stream was restarted in between; Spark tells the source of a
batch's end when it plans the next one, so the last batch waits until then.

A stream that starts before there is any entry runs one empty batch, because
Spark asks every source for a first offset.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .history import History
from .manifest import MANIFEST_SCHEMA, LogEntry
from .readers import LogReader, ManifestReader

# Schema of the rows, and how many offsets stay readable.
LINES_SCHEMA = "name string not null, cti timestamp not null, value string not null"
OFFSETS_KEPT = 128

OPEN_COST = 4 << 20  # bytes that a small piece counts more, for opening its file


Piece = tuple[LogEntry, int, Any]  # entry, its partition, a split of that


@dataclass
class LinesPartition(InputPartition):
    pieces: list[Piece]


@dataclass
class EntriesPartition(InputPartition):
    entries: list[tuple[int, LogEntry]]


class BatchLogStream(DataSourceStreamReader):
    def __init__(self, reader: LogReader, history: str, options: dict[str, Any]):
        self._reader = reader
        self._history_path = history
        self._options = options
        self._offset: int | None = None
        self._entries: list[LogEntry] = []

    def _history(self) -> History:
        return History(self._history_path)

    def initialOffset(self) -> dict:
        return {"v": -1}

    def latestOffset(self) -> dict:
        history = self._history()
        if self._offset is None:
            # A new process goes on from the last offset that was written down.
            self._offset = history.newest()
            self._entries = history.read(self._offset) if self._offset >= 0 else []
        for _ in range(self._options["stepsPerBatch"]):
            if self._offset < 0:
                found = self._reader.initial()
                moved = len(found) > 0
            else:
                found = self._reader.next_set(self._entries)
                moved = found != self._entries
            if not moved:
                break
            history.write(self._offset + 1, found)
            self._offset += 1
            self._entries = found
        return {"v": self._offset}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        history = self._history()
        chosen: list[tuple[int, LogEntry]] = []
        for offset in range(start["v"] + 1, end["v"] + 1):
            entries = history.read(offset)
            if self._options["emit"] == "new" and offset > 0:
                before = set(history.read(offset - 1))
                entries = [entry for entry in entries if entry not in before]
            chosen += [(offset, entry) for entry in entries]
        if self._options["content"] == "entries":
            return [EntriesPartition(chosen)] if chosen else []
        pieces = [
            (entry, index, split)
            for _, entry in chosen
            if entry.is_ready
            for index in range(entry.partitions)
            for split in self._reader.splits(entry, index)
        ]
        return [LinesPartition(shared) for shared in self._shared(pieces)]

    def _shared(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        """Neighbouring small pieces share a task; what has no known size gets its own."""
        together: list[Piece] = []
        room = 0
        for piece in pieces:
            size = self._reader.size_of(piece[2])
            cost = self._reader.task_bytes if size is None else size + OPEN_COST
            if together and cost > room:
                yield together
                together = []
            if not together:
                room = self._reader.task_bytes
            together.append(piece)
            room -= cost
        if together:
            yield together

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, EntriesPartition):
            yield _entries_batch(partition.entries)
            return
        for entry, index, split in partition.pieces:
            moment = pa.scalar(0 if entry.is_snapshot else entry.cti_ms * 1000, pa.int64())
            for lines in self._reader.read(entry, index, split):
                size = len(lines)
                time = pa.repeat(moment, size).cast(pa.timestamp("us", tz="UTC"))
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(entry.name), size), time, lines], ["name", "cti", "value"]
                )

    def commit(self, end: dict) -> None:
        history = self._history()
        for offset in history.waiting(end["v"]):
            for entry in history.read(offset):
                self._reader.acknowledge(entry)
            history.acknowledge(offset)
        history.drop_below(end["v"] - self._options["minLogs"])


def _entries_batch(chosen: list[tuple[int, LogEntry]]) -> pa.RecordBatch:
    entries = [entry for _, entry in chosen]
    times = [datetime.fromtimestamp(e.cti_ms / 1000, UTC) for e in entries]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([offset for offset, _ in chosen], pa.int64()),
            pa.array([e.name for e in entries], pa.string()),
            pa.array(times, pa.timestamp("us", tz="UTC")),
            pa.array([e.partitions for e in entries], pa.int32()),
            pa.array([e.is_snapshot for e in entries], pa.bool_()),
            pa.array([e.is_ready for e in entries], pa.bool_()),
            pa.array([e.path for e in entries], pa.string()),
        ],
        ["offset", "name", "cti", "partitions", "is_snapshot", "is_ready", "path"],
    )


def find_reader(name: str | None, known: list[type[LogReader]]) -> type[LogReader]:
    """The one reader of that name, in any case."""
    names = sorted(reader.short_name for reader in known)
    if not name:
        raise ValueError(f"the option reader is missing; known readers: {names}")
    matches = [reader for reader in known if reader.short_name.lower() == name.lower()]
    if len(matches) != 1:
        raise ValueError(f"{len(matches)} readers are named {name!r}; known readers: {names}")
    return matches[0]


def register(spark: SparkSession, *readers: type[LogReader]) -> None:
    """Make ``format("batchlog")`` known, with extra readers beside ``manifest``."""
    known: list[type[LogReader]] = [ManifestReader, *readers]
    for reader in readers:
        # Readers travel to the workers by value, wherever they are defined.
        cloudpickle.register_pickle_by_value(sys.modules[reader.__module__])

    class BatchLogSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "batchlog"

        def schema(self) -> str:
            content = self.options.get("content", "lines")
            if content not in ("lines", "entries"):
                raise ValueError(f"content must be 'lines' or 'entries', not {content!r}")
            return LINES_SCHEMA if content == "lines" else MANIFEST_SCHEMA

        def streamReader(self, schema) -> BatchLogStream:
            reader = find_reader(self.options.get("reader"), known)()
            reader.configure(self.options)
            if not self.options.get("historyPath"):
                raise ValueError("the option historyPath is missing")
            emit = self.options.get("emit", "set")
            if emit not in ("set", "new"):
                raise ValueError(f"emit must be 'set' or 'new', not {emit!r}")
            kept = int(self.options.get("minLogs", OFFSETS_KEPT))
            if kept < 1:
                raise ValueError("minLogs must be positive")
            steps = int(self.options.get("stepsPerBatch", 1))
            if steps < 1:
                raise ValueError("stepsPerBatch must be positive")
            chosen = {
                "emit": emit,
                "stepsPerBatch": steps,
                "content": self.options.get("content", "lines"),
                "minLogs": kept,
            }
            return BatchLogStream(reader, self.options["historyPath"], chosen)

    spark.dataSource.register(BatchLogSource)
