"""Session helpers: temporary settings, working folders, small file operations."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_local_scratch: dict[str, str] = {}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set SQL options for the length of a block.

    A stream copies the session's options when it starts, so starting it inside
    the block is enough.
    """
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def state_settings(spark: SparkSession, **extra: str) -> dict[str, str]:
    """Options for streams that keep state.

    RocksDB keeps state outside the heap and logs changes per batch.  The number of
    state partitions is the session's ``spark.sql.shuffle.partitions``.
    """
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    values = {
        "spark.sql.streaming.stateStore.providerClass": provider,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    values.update(extra)
    return values


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster, or a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_scratch[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


class Files:
    """The few file operations sinks and purges need, through Spark's own file
    system layer, so that any URI scheme Spark knows works."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(root).getFileSystem(self._conf)

    def qualified(self, path: str) -> str:
        return self._fs.makeQualified(self._path(path)).toUri().toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def is_file(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self._path(path)).isFile()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        found = (s.getPath().getName() for s in self._fs.listStatus(self._path(path)))
        return sorted(name for name in found if not name.startswith("."))

    def text(self, path: str) -> str:
        """A small file as a whole."""
        stream = self._fs.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def size(self, path: str) -> int:
        return self._fs.getContentSummary(self._path(path)).getLength()

    def put(self, path: str, text: str) -> None:
        """Write a small file in one step: readers see all of it or nothing."""
        folder, _, name = path.rpartition("/")
        partial = self._path(f"{folder}/.{name}.{uuid.uuid4().hex[:8]}.partial")
        stream = self._fs.create(partial, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        target = self._path(path)
        if not self._fs.rename(partial, target):
            self._fs.delete(target, False)
            if not self._fs.rename(partial, target):
                raise OSError(f"could not write {path}")
