"""A text sink that sends each row to the output path the row names.

Layout under the sink's root::

    data/batch_id=N/out_path=P/part-*.txt    the rows of batch N for path P
    ledger/N.start, ledger/N.done            one small JSON file each
    ledger/N.expiry                          when the batch may be deleted

A batch folder is written as a whole.  A batch with a done row is skipped, one
with only a start row is written again in place of the failed attempt, so every
row is there once whatever was repeated.  The text of a path is the text of its
batches in order; ``compact`` puts all of it into few files, ``compact_new`` adds what
came since the last time as a generation::

    data/generation=N/out_path=P/part-*.txt  the text of batches N to M for path P
    switch/N                                 the record that puts it in force
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime, timedelta
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.window import Window

from ..functions.scalars import batch_of_flag, duration_seconds, is_flag_name
from ..session import Files

LEDGER_SCHEMA = "batch_id long, status string, written_at timestamp, expires_at timestamp"
# Fixed value: how many batches keep their ledger rows.
BATCHES_KEPT = 100
FILE_BYTES = 128 << 20


class AppendSink:
    """The sink's settings and its batch function.

    ``path`` and ``value`` are columns of the incoming rows; rows where either
    is null are left out.  With ``order`` the rows of a path are kept in that
    order inside a batch, at the price of one range shuffle, which also spreads
    a path with very many rows over several files.  Without it rows are written
    where they are.
    """

    def __init__(
        self,
        root: str,
        path: Column,
        value: Column,
        order: list[Column] | None = None,
        expiry: str | None = None,
        keep: int = BATCHES_KEPT,
        clock: Callable[[], datetime] = lambda: datetime.now(UTC),
    ):
        if not root:
            raise ValueError("root must name a folder")
        if keep < 1:
            raise ValueError("keep must be positive")
        self.root = root.rstrip("/")
        self.path, self.value, self.order = path, value, order
        self.expiry = None if expiry is None else duration_seconds(expiry)
        self.keep = keep
        self.clock = clock

    def stream(self, rows: DataFrame) -> DataStreamWriter:
        return rows.writeStream.foreachBatch(self.write_batch)

    def write_batch(self, rows: DataFrame, batch_id: int) -> bool:
        """Write one batch; false if it was written before."""
        spark = rows.sparkSession
        ledger = Ledger(spark, self.root)
        if ledger.has(batch_id, "done"):
            return False
        ledger.add(batch_id, "start", self.clock())
        routed = route(rows, self.path, self.value, self.order)
        (
            routed.write.mode("overwrite")
            .partitionBy("out_path")
            .text(f"{self.root}/data/batch_id={batch_id}")
        )
        now = self.clock()
        if self.expiry is not None:
            ledger.add(batch_id, "expiry", now, now + timedelta(seconds=self.expiry))
        ledger.add(batch_id, "done", now)
        ledger.purge(batch_id - self.keep)
        return True


def route(
    rows: DataFrame, path: Column, value: Column, order: list[Column] | None = None
) -> DataFrame:
    """Columns ``out_path`` and ``value`` of the rows that have both."""
    keys = [column.alias(f"order_{i}") for i, column in enumerate(order or [])]
    routed = rows.select(path.alias("out_path"), value.alias("value"), *keys)
    routed = routed.dropna(subset=["out_path", "value"])
    unnamed = F.raise_error(F.lit("the output path of a row is empty"))
    routed = routed.withColumn("out_path", F.when(F.col("out_path") == "", unnamed).otherwise(F.col("out_path")))
    if order:
        by = ["out_path", *(f"order_{i}" for i in range(len(keys)))]
        routed = routed.repartitionByRange(*by).sortWithinPartitions(*by)
    return routed.select("out_path", "value")


class Ledger:
    """Records of the batches, one small file each."""

    def __init__(self, spark: SparkSession, root: str):
        self._files = Files(spark, root)
        self._folder = f"{root}/ledger"

    def has(self, batch_id: int, status: str) -> bool:
        return self._files.exists(f"{self._folder}/{batch_id}.{status}")

    def add(
        self, batch_id: int, status: str, at: datetime, expires_at: datetime | None = None
    ) -> None:
        record = {"batch_id": batch_id, "status": status, "written_at": at.isoformat()}
        if expires_at is not None:
            record["expires_at"] = expires_at.isoformat()
        self._files.put(f"{self._folder}/{batch_id}.{status}", json.dumps(record))

    def purge(self, threshold: int) -> None:
        """Drop start and done records below the threshold; expiries stay."""
        for name in self._files.names(self._folder):
            batch_id, _, status = name.partition(".")
            if batch_id.isdigit() and status in ("start", "done") and int(batch_id) < threshold:
                self._files.delete(f"{self._folder}/{name}")

    def drop(self, batch_id: int) -> None:
        for status in ("start", "done", "expiry"):
            self._files.delete(f"{self._folder}/{batch_id}.{status}")


def ledger_table(spark: SparkSession, root: str) -> DataFrame:
    """The ledger as rows; empty if nothing was written yet."""
    if not Files(spark, root).names(f"{root}/ledger"):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).json(f"{root}/ledger")


def appended(spark: SparkSession, root: str) -> DataFrame:
    """The rows of finished batches: ``batch_id``, ``out_path``, ``value``.

    What an attempt wrote that has no done record yet isn't shown.  Batches older than
    all records had theirs purged, so they were done.
    """
    schema = "value string, batch_id long, out_path string"
    batches = finished(spark, root)
    return _batches(spark, root, batches) if batches else spark.createDataFrame([], schema)


def finished(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the batches in ``root`` that were written as a whole."""
    files = Files(spark, root)
    records = [name.partition(".") for name in files.names(f"{root}/ledger")]
    done = {int(n) for n, _, status in records if status == "done" and n.isdigit()}
    started = {int(n) for n, _, status in records if status in ("start", "done") and n.isdigit()}
    oldest = min(started, default=0)
    names = (name.removeprefix("batch_id=") for name in files.names(f"{root}/data"))
    return sorted(int(n) for n in names if n.isdigit() and (int(n) in done or int(n) < oldest))


def compact(spark: SparkSession, root: str, target: str, file_bytes: int = FILE_BYTES) -> None:
    """Put the text of each path into few files, in the order it was appended.

    The order is that of the batches, of the files in a batch, and of the lines
    in a file.  Partitions are ranges of that order: a small path becomes one
    file, or two where a range ends inside it, a large one becomes several whose
    names sort in the order of their lines.
    """
    batches = finished(spark, root)
    _store(_placed(appended(spark, root)), _size(spark, root, batches), target, file_bytes)


def compact_new(
    spark: SparkSession,
    root: str,
    target: str,
    file_bytes: int = FILE_BYTES,
    together: str = "1.00:00:00",
) -> list[int]:
    """Add the batches that finished since the last call to ``target``; new generations.

    What was compacted before is neither read nor written.  A generation is a run of
    batches, is named after the first of them, and counts from the moment its switch
    record is there; an attempt that failed before is written again as a whole.
    Batches are in one generation if they expire in the same stretch of ``together``, so
    expired text stays for that long at most.  One call at a time may work on a target.
    """
    files = Files(spark, target)
    mark = max((record["last"] for record in _switches(files, target)), default=-1)
    fresh = [n for n in finished(spark, root) if n > mark]
    # One row per batch.
    rows = ledger_table(spark, root).filter((F.col("status") == "expiry") & (F.col("batch_id") > mark))
    until = {row.batch_id: row.s for row in rows.select("batch_id", F.col("expires_at").cast("double").alias("s")).collect()}
    stretch = duration_seconds(together)
    added = []
    for _, run in groupby(fresh, lambda n: until[n] // stretch if n in until else None):
        batches = list(run)
        first, last = batches[0], batches[-1]
        folder = f"{target}/data/generation={first}"
        files.delete(folder)
        filled = [n for n in batches if _has_rows(files, f"{root}/data/batch_id={n}")]
        if filled:
            _store(_placed(_batches(spark, root, filled)), _size(spark, root, filled), folder, file_bytes)
        expires = max(until[n] for n in batches) if first in until else None
        _switch(files, target, {"first": first, "last": last, "expires": expires, "gone": False})
        added.append(first)
    return added


def compacted(spark: SparkSession, target: str) -> DataFrame:
    """The text that ``compact_new`` gathered: ``generation``, ``out_path``, ``line``, ``value``.

    ``line`` counts the lines of a path from 0, in the order they were appended.
    """
    files = Files(spark, target)
    folders = [f"{target}/data/generation={r['first']}" for r in _switches(files, target) if not r["gone"]]
    folders = [folder for folder in folders if _has_rows(files, folder)]
    if not folders:
        return spark.createDataFrame([], "generation long, out_path string, line long, value string")
    schema = "value string, generation long, out_path string"
    text = spark.read.schema(schema).option("basePath", f"{target}/data").text(folders, lineSep="\n")
    lines = _placed(text)
    # A block is one task's work when it is read; there are few of them to a path.
    block = ["out_path", "generation", "file", "block"]
    ahead = Window.partitionBy("out_path").orderBy(*block[1:]).rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy(*block).agg(F.count("*").alias("n"))
    starts = blocks.select(*block, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    within = F.col("line") - F.min("line").over(Window.partitionBy(*block))
    return (
        lines.withColumn("within", within)
        .join(starts, block)
        .select("generation", "out_path", (F.col("start") + F.col("within")).alias("line"), "value")
    )


def _batches(spark: SparkSession, root: str, batches: list[int]) -> DataFrame:
    schema = "value string, batch_id long, out_path string"
    paths = [f"{root}/data/batch_id={n}" for n in batches]
    return spark.read.schema(schema).option("basePath", f"{root}/data").text(paths, lineSep="\n")


def _placed(text: DataFrame) -> DataFrame:
    """Lines with their place: the folder's columns, then ``file``, ``block`` and ``line``."""
    return text.select(
        *text.columns,
        F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Increases along the lines of one file block, which is one task's work.
        F.monotonically_increasing_id().alias("line"),
    )


def _store(lines: DataFrame, size: int, folder: str, file_bytes: int) -> None:
    """Write the text of each path in order, as files of about ``file_bytes``."""
    place = ["out_path", "batch_id", "file", "block", "line"]
    (
        lines.repartitionByRange(max(1, -(-size // file_bytes)), *place)
        .sortWithinPartitions(*place)
        .select("out_path", "value")
        .write.mode("overwrite")
        .partitionBy("out_path")
        .text(folder)
    )


def _size(spark: SparkSession, root: str, batches: list[int]) -> int:
    files = Files(spark, root)
    return sum(files.size(f"{root}/data/batch_id={n}") for n in batches)


def _has_rows(files: Files, folder: str) -> bool:
    return any(name.startswith("out_path=") for name in files.names(folder))


def _switches(files: Files, target: str) -> list[dict]:
    """Records of the generations, one small file each, in order."""
    names = [name for name in files.names(f"{target}/switch") if name.isdigit()]
    return [json.loads(files.text(f"{target}/switch/{name}")) for name in sorted(names, key=int)]


def _switch(files: Files, target: str, record: dict) -> None:
    files.put(f"{target}/switch/{record['first']}", json.dumps(record))


def expire(spark: SparkSession, root: str, now: datetime, target: str | None = None) -> list[int]:
    """Delete the batches whose expiry has passed, data before ledger rows.

    With the ``target`` of ``compact_new`` also the generations all of whose batches expired.
    """
    ledger = ledger_table(spark, root)
    moment = F.lit(now.isoformat()).cast("timestamp")
    # One row per batch.
    old = ledger.filter((F.col("status") == "expiry") & (F.col("expires_at") <= moment))
    batches = sorted(row.batch_id for row in old.select("batch_id").collect())
    files, records = Files(spark, root), Ledger(spark, root)
    for batch_id in batches:
        files.delete(f"{root}/data/batch_id={batch_id}")
        records.drop(batch_id)
    if target is not None:
        _expire_generations(Files(spark, target), target, now.timestamp())
    return batches


def _expire_generations(files: Files, target: str, now: float) -> None:
    """Generations go out of force first, then their data goes.

    The newest record stays, as it says how far the compaction came.
    """
    switches = _switches(files, target)
    for record in switches:
        if not record["gone"] and (record["expires"] is None or record["expires"] > now):
            continue
        if not record["gone"]:
            _switch(files, target, record | {"gone": True})
        files.delete(f"{target}/data/generation={record['first']}")
        if record is not switches[-1]:
            files.delete(f"{target}/switch/{record['first']}")


def flag_batches(names: DataFrame, name: str) -> DataFrame:
    """Distinct batch ids of flag names; names of another form are ignored."""
    flags = names.filter(is_flag_name(F.col(name)))
    return flags.select(batch_of_flag(F.col(name)).alias("batch_id")).distinct()


def retained(batches: DataFrame, keep: int = BATCHES_KEPT) -> DataFrame:
    """The batches that a purge after the newest one leaves."""
    # One row per batch, so a window over all of them is small.
    newest = F.max("batch_id").over(Window.partitionBy())
    return (
        batches.withColumn("newest", newest)
        .filter(F.col("batch_id") >= F.col("newest") - keep)
        .select("batch_id")
    )
