"""A manifest reader that writes down what was acknowledged."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import entry_from_json
from .manifest import LogEntry
from .readers import ManifestReader, file_system


class RecordingReader(ManifestReader):
    """Like ``manifest``; each acknowledgement is a small file in ``acknowledgedPath``."""

    short_name = "recording"

    def configure(self, options: dict[str, str]) -> None:
        super().configure(options)
        if not options.get("acknowledgedPath"):
            raise ValueError("the recording reader needs the option acknowledgedPath")
        self.acknowledged_path = options["acknowledgedPath"].rstrip("/")

    def acknowledge(self, entry: LogEntry) -> None:
        fs, folder = file_system(self.acknowledged_path)
        fs.create_dir(folder, recursive=True)
        name = f"{entry.step}-{uuid.uuid4().hex}"
        with fs.open_output_stream(f"{folder}/.{name}") as stream:
            stream.write(entry.to_line().encode("utf-8"))
        fs.move(f"{folder}/.{name}", f"{folder}/{name}")


def acknowledged_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per acknowledged entry and step, with the number of calls."""
    lines = spark.read.text(path, lineSep="\n")
    step = F.regexp_extract("_metadata.file_name", r"^(\d+)-", 1).cast("long").alias("offset")
    return (
        lines.select(step, entry_from_json(F.col("value")).alias("entry"))
        .groupBy("offset", "entry.name", "entry.cti_ms")
        .agg(F.count("*").alias("calls"))
    )
