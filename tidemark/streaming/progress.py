"""The reports of streams as a table, however many batches they run.

A listener puts the report of each batch into a file of its own as the batch ends.
A batch that is repeated after a restart replaces its report.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.window import Window

from ..session import Files

# The fields of Spark's reports that are used here.
REPORT = (
    "id string, batchId long, numInputRows long, eventTime map<string, string>, "
    "stateOperators array<struct<operatorName: string, numRowsTotal: long, numRowsUpdated: long, "
    "numRowsRemoved: long, numRowsDroppedByWatermark: long, memoryUsedBytes: long>>"
)


class ProgressTable(StreamingQueryListener):
    """Keeps every report of the session's streams under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._files = Files(spark, root)
        self._ended: defaultdict[str, Event] = defaultdict(Event)
        self._error: Exception | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        try:
            self._files.put(f"{self.root}/{report.id}/{report.batchId}.json", report.json)
        except Exception as error:  # Spark would only log it; wait() raises it
            self._error = error

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all reports of an ended run are kept; an error if one couldn't be."""
        if not self._ended[str(query.runId)].wait(seconds):
            raise TimeoutError("the stream's end was not reported")
        if self._error is not None:
            raise self._error


@contextmanager
def recorded(spark: SparkSession, root: str) -> Iterator[ProgressTable]:
    """Keep the reports of the streams that run inside the block."""
    table = ProgressTable(spark, root)
    spark.streams.addListener(table)
    try:
        yield table
    finally:
        spark.streams.removeListener(table)


def reports(spark: SparkSession, root: str) -> DataFrame:
    """One row per stream and batch, as Spark reported it."""
    if not Files(spark, root).names(root):
        return spark.createDataFrame([], REPORT)
    return spark.read.schema(REPORT).option("recursiveFileLookup", "true").json(root)


def metrics(spark: SparkSession, root: str) -> DataFrame:
    """One row per stream, batch and stateful operator."""
    each = reports(spark, root).select("id", "batchId", F.posexplode("stateOperators").alias("operator", "o"))
    return each.select(
        F.col("id").alias("query_id"),
        F.col("batchId").alias("batch_id"),
        "operator",
        F.col("o.operatorName").alias("operator_name"),
        F.col("o.numRowsTotal").alias("rows_total"),
        F.col("o.numRowsUpdated").alias("rows_updated"),
        F.col("o.numRowsRemoved").alias("rows_removed"),
        F.col("o.numRowsDroppedByWatermark").alias("rows_late"),
        F.col("o.memoryUsedBytes").alias("memory_bytes"),
    )


def watermarks(spark: SparkSession, root: str) -> DataFrame:
    """Per stream and batch: the watermark in force, and that of the next batch, null for the last."""
    in_force = reports(spark, root).select(
        F.col("id").alias("query_id"),
        F.col("batchId").alias("batch_id"),
        F.unix_millis(F.col("eventTime")["watermark"].cast("timestamp")).alias("watermark_ms"),
    )
    following = F.lead("watermark_ms").over(Window.partitionBy("query_id").orderBy("batch_id"))
    return in_force.filter("watermark_ms is not null").withColumn("next_watermark_ms", following)
