"""The stream source's own record of which entries each offset stood for.

One small file per offset: a version line, then one JSON object per entry.  The
file is complete before the offset is given out, so a restarted stream can read
the same range again.  Steps behind the mark of the last acknowledged one are the queue
of those that still wait.
"""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import entry_from_json
from .manifest import LogEntry
from .readers import file_system

# Fixed value: first line of every history file.
VERSION_LINE = "v1"
MARK = "_acknowledged"


class History:
    def __init__(self, path: str):
        self._fs, self._folder = file_system(path.rstrip("/"))

    def _file(self, offset: int) -> str:
        return f"{self._folder}/{offset}"

    def offsets(self) -> list[int]:
        found = self._fs.get_file_info(pafs.FileSelector(self._folder, allow_not_found=True))
        return sorted(int(info.base_name) for info in found if info.base_name.isdigit())

    def newest(self) -> int:
        return max(self.offsets(), default=-1)

    def read(self, offset: int) -> list[LogEntry]:
        if self._fs.get_file_info(self._file(offset)).type == pafs.FileType.NotFound:
            raise ValueError(f"no history for offset {offset} in {self._folder}")
        with self._fs.open_input_stream(self._file(offset)) as stream:
            lines = stream.read().decode("utf-8").splitlines()
        if not lines:
            raise ValueError(f"history file of offset {offset} is empty")
        if lines[0] != VERSION_LINE:
            raise ValueError(f"history file of offset {offset} has version {lines[0]!r}")
        return [LogEntry.from_line(line) for line in lines[1:]]

    def write(self, offset: int, entries: list[LogEntry]) -> None:
        if self._fs.get_file_info(self._file(offset)).type != pafs.FileType.NotFound:
            raise ValueError(f"another stream wrote offset {offset} in {self._folder}")
        self._fs.create_dir(self._folder, recursive=True)
        self._put(str(offset), "\n".join([VERSION_LINE, *(entry.to_line() for entry in entries)]))

    def _put(self, name: str, text: str) -> None:
        """Write a small file in one step."""
        partial = f"{self._folder}/.{name}.{uuid.uuid4().hex[:8]}"
        with self._fs.open_output_stream(partial) as stream:
            stream.write(text.encode("utf-8"))
        self._fs.move(partial, f"{self._folder}/{name}")

    def acknowledged(self) -> int:
        """The last offset whose entries were all acknowledged.

        Without a mark it is the one before the oldest offset that is kept.
        """
        mark = f"{self._folder}/{MARK}"
        if self._fs.get_file_info(mark).type == pafs.FileType.NotFound:
            return min(self.offsets(), default=0) - 1
        with self._fs.open_input_stream(mark) as stream:
            return int(stream.read())

    def waiting(self, end: int) -> range:
        """Offsets up to ``end`` that still wait for their acknowledgement, oldest first."""
        return range(self.acknowledged() + 1, end + 1)

    def acknowledge(self, offset: int) -> None:
        self._put(MARK, str(offset))

    def drop_below(self, offset: int) -> None:
        for old in self.offsets():
            if old < offset:
                self._fs.delete_file(self._file(old))


def history_table(spark: SparkSession, path: str) -> DataFrame:
    """The history as rows, one per offset and entry; a bad version line fails."""
    lines = spark.read.text(path, lineSep="\n").select(
        F.regexp_extract("_metadata.file_name", r"(\d+)$", 1).cast("long").alias("offset"), "value"
    )
    entry = (
        F.when(F.col("value").startswith("{"), entry_from_json(F.col("value")))
        .when(F.col("value") == VERSION_LINE, None)
        .otherwise(F.raise_error(F.concat(F.lit("bad history line: "), "value")))
    )
    return (
        lines.withColumn("entry", entry)
        .filter("entry is not null")
        .select(
            "offset",
            "entry.name",
            "entry.cti_ms",
            "entry.partitions",
            "entry.is_snapshot",
            "entry.is_ready",
            "entry.path",
        )
    )
