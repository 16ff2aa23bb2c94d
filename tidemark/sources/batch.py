"""Batch reads of a log: Spark's native text scan over the entries' folders."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..session import Files
from .manifest import MANIFEST_SCHEMA, stamp

PART_OF_FILE = r"/part=([0-9]+)/[^/]+$"
BROADCAST_BYTES = 8 << 20  # of folder names; more entries are joined by a shuffle


def read_batch_log(
    spark: SparkSession,
    manifest: DataFrame,
    start: int = -1,
    end: int | None = None,
    emit: str = "set",
    with_partition: bool = False,
) -> DataFrame:
    """Rows ``(name, cti, value)`` of the steps in ``(start, end]``.

    Only ready entries are read, and only their folders are listed.  An entry
    that stays in the set for several steps is emitted at each of them;
    ``emit="new"`` emits it once.  A step whose set equals that of the step before
    brings nothing new and is passed over.  A step missing from the range is an error.
    """
    if emit not in ("set", "new"):
        raise ValueError(f"emit must be 'set' or 'new', not {emit!r}")
    chosen = manifest.filter(F.col("offset") >= start)
    if end is not None:
        chosen = chosen.filter(F.col("offset") <= end)
    # Control data: one row per entry of the range, and of the step ahead of it.
    steps: dict[int, list[Row]] = {}
    for row in _control_rows(chosen):
        steps.setdefault(row.offset, []).append(row)
    last = end if end is not None else max(steps, default=start)
    if missing := set(range(max(start, -1) + 1, last + 1)) - set(steps):
        raise ValueError(f"the manifest lacks steps {sorted(missing)[:5]} up to {last}")
    sets = {offset: Counter(row[1:] for row in found) for offset, found in steps.items()}
    rows = []
    for offset in sorted(step for step in steps if step > start):
        before = sets.get(offset - 1, Counter())
        if sets[offset] != before:
            rows += [row for row in steps[offset] if emit == "set" or row[1:] not in before]
    return _scan(spark, rows, with_partition)


def scan_entries(spark: SparkSession, entries: DataFrame, with_partition: bool = False) -> DataFrame:
    """Lines of the ready entries of a manifest, whatever their steps."""
    return _scan(spark, _control_rows(entries), with_partition)


def _control_rows(entries: DataFrame) -> list[Row]:
    micros = F.unix_micros("cti").alias("cti_us")
    flags = ["partitions", "is_snapshot", "is_ready"]
    return entries.select("offset", "name", micros, "path", *flags).collect()


def _scan(spark: SparkSession, entries: list[Row], with_partition: bool) -> DataFrame:
    """One native scan of the folders of all ready entries.

    Lines get their entry's columns through a join on the folder, a broadcast
    one as long as the entries are few.
    """
    rows = [row for row in entries if row.is_ready]
    columns = ["name", "cti", "value"] + (["partition"] if with_partition else [])
    if not rows:
        empty = "name string, cti timestamp, value string"
        return spark.createDataFrame([], empty + (", partition int" if with_partition else ""))
    folders = _folder_keys(spark, {row.path for row in rows})
    spelt = [(key, row) for row in rows for key in folders[row.path]]
    # An Arrow table becomes a local relation: neither a job nor a Python worker is needed for it.
    keyed = spark.createDataFrame(
        pa.table(
            {
                "folder": pa.array([key for key, _ in spelt], pa.string()),
                "name": pa.array([row.name for _, row in spelt], pa.string()),
                "cti_us": pa.array([row.cti_us for _, row in spelt], pa.int64()),
                "is_snapshot": pa.array([row.is_snapshot for _, row in spelt], pa.bool_()),
                "partitions": pa.array([row.partitions for _, row in spelt], pa.int32()),
            }
        )
    )
    if sum(len(key) + 64 for key, _ in spelt) <= BROADCAST_BYTES:
        keyed = F.broadcast(keyed)
    file = F.col("_metadata.file_path")
    part = F.regexp_extract(file, PART_OF_FILE, 1).try_cast("int")
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(list(folders), lineSep="\n")
        .select(
            "value",
            _entry_folder().alias("folder"),
            part.alias("partition"),
        )
    )
    # The stream form refuses the same files: none is passed over in silence.
    stray = F.raise_error(F.concat(F.lit("a file belongs to no partition of its entry: "), "folder"))
    known = F.col("partitions").isNotNull() & (F.coalesce("partition", F.lit(0)) < F.col("partitions"))
    return (
        lines.join(keyed, "folder", "left")
        .withColumn("name", F.when(known, F.col("name")).otherwise(stray))
        .withColumn("cti", stamp(F.col("is_snapshot"), F.timestamp_micros("cti_us")))
        .select(*columns)
    )


def _folder_keys(spark: SparkSession, paths: set[str]) -> dict[str, list[str]]:
    """The spellings of each folder that ``_metadata.file_path`` may show.

    Local paths come as ``file:/x`` or ``file:///x``.
    """
    systems: dict[str, Files] = {}
    keys = {}
    for path in paths:
        root = path[: path.find("/", path.index("://") + 3) + 1] if "://" in path else "/"
        if root not in systems:
            systems[root] = Files(spark, path)
        key = systems[root].qualified(path.rstrip("/"))
        keys[path] = [key]
        if key.startswith("file:"):
            inner = key[len("file:") :].lstrip("/")
            keys[path] = [f"file:/{inner}", f"file:///{inner}"]
    return keys


def _entry_folder() -> Column:
    """A file belongs to the entry whose folder holds it, directly or in part=i.

    This runs for every line, so it is built from plain substrings.
    """

    def name(path: str) -> str:
        return f"substring_index({path}, '/', -1)"

    def parent(path: str) -> str:
        return f"left({path}, length({path}) - length({name(path)}) - 1)"

    folder = parent("_metadata.file_path")
    return F.expr(f"if(startswith({name(folder)}, 'part='), {parent(folder)}, {folder})")


def for_each_log_batch(
    entries: DataFrame, handle: Callable[[DataFrame, int], None], with_partition: bool = False
) -> DataStreamWriter:
    """Drive native scans from a stream of entries (``content = entries``).

    The stream carries one row per entry; the lines themselves are read by
    Spark's text scan in each micro-batch and never pass through Python.
    """

    def scan(batch: DataFrame, batch_id: int) -> None:
        handle(scan_entries(batch.sparkSession, batch, with_partition), batch_id)

    return entries.writeStream.foreachBatch(scan)


__all__ = ["MANIFEST_SCHEMA", "for_each_log_batch", "read_batch_log", "scan_entries"]
