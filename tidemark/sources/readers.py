"""Log readers: how a batch log finds its entries and reads their lines.

The methods about entries run on the driver; ``splits`` too.  Only ``read``
runs in tasks, one task per split.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs

from .manifest import LogEntry

BLOCK = 8 << 20
TASK_BYTES = 128 << 20

# Endings of compressed files, with Arrow's name of the form where it has one.
CODECS = {".gz": "gzip", ".bz2": "bz2", ".zst": None, ".lz4": None, ".snappy": None, ".deflate": None}


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a path or URI, and the path inside it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return pafs.LocalFileSystem(), path


class LogReader:
    """Base class of readers.  A stream names its reader by ``short_name``."""

    short_name = ""
    task_bytes = TASK_BYTES

    def configure(self, options: dict[str, str]) -> None:
        """Take the options of the stream; keys ignore case."""

    def initial(self) -> list[LogEntry]:
        """The first set of entries, empty while there is none."""
        raise NotImplementedError

    def next_entry(self, entry: LogEntry) -> LogEntry:
        """The entry that follows, or the same one if there is no later."""
        return entry

    def next_set(self, entries: list[LogEntry]) -> list[LogEntry]:
        """The set that follows; by default each entry advances by itself."""
        return [self.next_entry(entry) for entry in entries]

    def splits(self, entry: LogEntry, partition: int) -> list[Any]:
        """Cut one partition of an entry into independent tasks.

        Called for the partitions of an entry one after the other, from 0 on.
        """
        return [None]

    def size_of(self, split: Any) -> int | None:
        """Bytes of a split; small ones share a task up to ``task_bytes``.  Unknown: none shares."""
        return None

    def read(self, entry: LogEntry, partition: int, split: Any) -> Iterator[pa.Array]:
        """Yield the lines of a split as string arrays of moderate size."""
        raise NotImplementedError

    def acknowledge(self, entry: LogEntry) -> None:
        """Called when the stream no longer needs the entry's step; again if that was cut short."""


class ManifestReader(LogReader):
    """Follows a manifest written by ``write_manifest``.

    Files in ``<path>/part=i/`` belong to partition i of the entry; files directly in its
    folder are dealt out by position.  A missing folder, a part beyond the entry's
    partitions and any other sub-folder are errors: nothing is passed over.  Files
    are cut into ranges of ``splitBytes`` so that one large partition becomes
    many tasks.  A compressed file (``.gz``, ``.bz2``) is one range; bytes that are no UTF-8 stay
    as they are.
    """

    short_name = "manifest"

    def configure(self, options: dict[str, str]) -> None:
        if not options.get("manifestPath"):
            raise ValueError("the manifest reader needs the option manifestPath")
        self.manifest_path = options["manifestPath"]
        self.split_bytes = self.task_bytes = int(options.get("splitBytes", TASK_BYTES))
        self._records: dict[tuple, list[LogEntry]] = {}
        self._known_steps: dict[int, list[LogEntry]] = {}
        self._files: list[tuple[str, int]] = []

    def _steps(self) -> dict[int, list[LogEntry]]:
        """The manifest; of its files only new and changed ones are read."""
        fs, folder = file_system(self.manifest_path)
        files = sorted(
            (info.path, info.size, info.mtime_ns)
            for info in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
            if info.is_file and not info.base_name.startswith(("_", "."))
        )
        if files != list(self._records):
            self._records = {
                file: self._records.get(file) or self._entries_of(fs, file[0]) for file in files
            }
            steps: dict[int, list[LogEntry]] = {}
            for found in self._records.values():
                for entry in found:
                    steps.setdefault(entry.step, []).append(entry)
            self._known_steps = {
                step: sorted(found, key=LogEntry.to_line) for step, found in steps.items()
            }
        return self._known_steps

    @staticmethod
    def _entries_of(fs: pafs.FileSystem, path: str) -> list[LogEntry]:
        with fs.open_input_stream(path) as stream:
            records = [json.loads(line) for line in stream.read().decode("utf-8").splitlines()]
        return [LogEntry(**{k: v for k, v in r.items() if k != "offset"}, step=r["offset"]) for r in records]

    def initial(self) -> list[LogEntry]:
        steps = self._steps()
        return steps[min(steps)] if steps else []

    def next_set(self, entries: list[LogEntry]) -> list[LogEntry]:
        """The next step that differs; steps that repeat the set are passed over."""
        here = max((entry.step for entry in entries), default=-1)
        for step, found in sorted(self._steps().items()):
            if step > here and found != entries:
                return found
        return entries

    def next_entry(self, entry: LogEntry) -> LogEntry:
        later = [
            other
            for found in self._steps().values()
            for other in found
            if other.name == entry.name and other.cti_ms > entry.cti_ms
        ]
        return min(later, key=lambda other: other.cti_ms, default=entry)

    def splits(self, entry: LogEntry, partition: int) -> list[tuple[str, int, int]]:
        fs, folder = file_system(entry.path.rstrip("/"))
        if partition == 0:
            # One listing serves all partitions of the entry.
            selector = pafs.FileSelector(folder, recursive=True)
            self._files = sorted(
                (info.path[len(folder) :], info.size)
                for info in fs.get_file_info(selector)
                if info.is_file and not _hidden(info.path[len(folder) :])
            )
            for path, _ in self._files:
                check_place(path, entry)
        beside = [f for f in self._files if "/" not in f[0][1:]]
        files = [f for f in self._files if f[0].startswith(f"/part={partition}/")]
        files += beside[partition :: entry.partitions]
        return [
            (entry.path.rstrip("/") + path, start, min(reach, size - start))
            for path, size in files
            for reach in [size if ending(path) else self.split_bytes]
            for start in range(0, size, max(reach, 1))
        ]

    def size_of(self, split: tuple[str, int, int]) -> int:
        return split[2]

    def read(
        self, entry: LogEntry, partition: int, split: tuple[str, int, int]
    ) -> Iterator[pa.Array]:
        path, start, length = split
        yield from lines_of_compressed(path) if ending(path) else lines_of_range(path, start, length)


def _hidden(path: str) -> bool:
    """As in Spark's own scans: a name in the path starts with ``_`` or ``.``."""
    return any(name.startswith(("_", ".")) for name in path.split("/"))


def check_place(path: str, entry: LogEntry) -> None:
    """A file lies in its entry's folder or in ``part=i`` with i below the partitions."""
    folders = path.strip("/").split("/")[:-1]
    if not folders:
        return
    part = folders[0].removeprefix("part=")
    if len(folders) > 1 or folders[0] == part or not part.isdigit() or int(part) >= entry.partitions:
        raise ValueError(f"{entry.path}{path} belongs to no partition of its entry ({entry.partitions})")


def ending(path: str) -> str | None:
    """The ending of a compressed file's name."""
    return next((end for end in CODECS if path.endswith(end)), None)


def lines_of_compressed(path: str) -> Iterator[pa.Array]:
    """All lines of a compressed text file, block by block."""
    codec = CODECS[ending(path)]
    if codec is None:
        raise ValueError(f"{path} is compressed in a form that only content=entries can read")
    fs, inner = file_system(path)
    with fs.open_input_stream(inner, compression=codec) as file:
        rest: list[bytes] = []
        while block := file.read(BLOCK):
            cut = block.rfind(b"\n") + 1
            if cut:
                yield _as_lines(b"".join([*rest, block[:cut]]))
                rest = []
            rest.append(block[cut:])
        if last := b"".join(rest):
            yield _as_lines(last)


def lines_of_range(path: str, start: int, length: int) -> Iterator[pa.Array]:
    """Lines that begin inside a byte range of a text file, block by block.

    A line belongs to the range that holds its first byte, so neighbouring
    ranges neither repeat nor lose one.
    """
    fs, inner = file_system(path)
    with fs.open_input_file(inner) as file:
        end = start + length
        position = start
        rest = b""
        if start > 0:
            # Begin one byte early: a line break just before the range means
            # that the range starts with a line of its own.
            file.seek(start - 1)
            position = start - 1
            while True:
                block = file.read(BLOCK)
                if not block:
                    return
                cut = block.find(b"\n")
                if cut >= 0:
                    position += cut + 1
                    rest = block[cut + 1 :]
                    break
                position += len(block)
        # ``position`` is the offset of the first byte of ``rest``.
        while position < end:
            block = file.read(BLOCK)
            data = rest + block
            if not data:
                return
            if position + len(data) >= end:
                # Keep the line that crosses the end of the range whole.
                while block and data.find(b"\n", max(end - position - 1, 0)) < 0:
                    block = file.read(BLOCK)
                    data += block
                stop = data.find(b"\n", max(end - position - 1, 0))
                data = data if stop < 0 else data[: stop + 1]
                yield _as_lines(data)
                return
            cut = data.rfind(b"\n")
            if not block:
                yield _as_lines(data)
                return
            if cut >= 0:
                yield _as_lines(data[: cut + 1])
                position += cut + 1
                rest = data[cut + 1 :]
            else:
                rest = data


def _as_lines(data: bytes) -> pa.Array:
    """Lines as one array over the bytes themselves, unchecked as in Spark's own scan."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == ord("\n"))
    if not data.endswith(b"\n"):
        ends = np.append(ends, len(data))
    places = np.zeros(len(ends) + 1, np.int32)
    places[1:] = ends - np.arange(len(ends))
    text = data.replace(b"\n", b"")
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(places), pa.py_buffer(text))
