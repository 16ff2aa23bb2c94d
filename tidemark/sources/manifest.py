"""Log entries and manifests.

A *log* describes a table that grows in steps.  Each step (offset) holds a set
of entries; an entry names a folder of text lines, the time of its batch (cti),
whether it is a full snapshot or a delta, and whether it may be read yet.  A
manifest is the DataFrame of all entries of all steps.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MANIFEST_SCHEMA = (
    "offset long, name string, cti timestamp, partitions int, "
    "is_snapshot boolean, is_ready boolean, path string"
)
IDENTITY = ["name", "cti", "partitions", "is_snapshot", "is_ready", "path"]


@dataclass(frozen=True)
class LogEntry:
    """One entry, in the form that readers and the stream source handle.

    ``step`` is the reader's own position; two entries are equal without it.
    """

    name: str
    cti_ms: int
    partitions: int = 1
    is_snapshot: bool = False
    is_ready: bool = True
    path: str = ""
    step: int = field(default=0, compare=False)

    def to_line(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_line(line: str) -> "LogEntry":
        return LogEntry(**json.loads(line))


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Store a manifest as JSON lines, readable by Spark and by log readers."""
    lines = manifest.select(
        "offset",
        "name",
        F.unix_millis("cti").alias("cti_ms"),
        "partitions",
        "is_snapshot",
        "is_ready",
        "path",
    )
    lines.coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema(
        "offset long, name string, cti_ms long, partitions int, "
        "is_snapshot boolean, is_ready boolean, path string"
    ).json(path)
    return stored.select(
        "offset",
        "name",
        F.timestamp_millis("cti_ms").alias("cti"),
        "partitions",
        "is_snapshot",
        "is_ready",
        "path",
    )


def stamp(is_snapshot: Column, cti: Column) -> Column:
    """Snapshot rows carry epoch zero, delta rows the time of their entry."""
    return F.when(is_snapshot, F.timestamp_millis(F.lit(0))).otherwise(cti)


def seen_before(manifest: DataFrame) -> DataFrame:
    """Add ``repeated``: whether the step before held the same entry."""
    previous = F.lag("offset").over(Window.partitionBy(*IDENTITY).orderBy("offset"))
    return manifest.withColumn(
        "repeated", F.coalesce(previous == F.col("offset") - 1, F.lit(False))
    )


def only_new(manifest: DataFrame) -> DataFrame:
    """Drop entries that the step before held already."""
    return seen_before(manifest).filter("not repeated").drop("repeated")


def sets_differ(left: DataFrame, right: DataFrame) -> DataFrame:
    """Entries held by only one of two sets; empty when the sets are equal."""
    a, b = left.select(*IDENTITY), right.select(*IDENTITY)
    gone = a.exceptAll(b).withColumn("side", F.lit("left"))
    return gone.unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
