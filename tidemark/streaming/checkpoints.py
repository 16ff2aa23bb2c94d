"""A stream's checkpoint as tables: state, changes, operators, watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


# Start a stream with this to keep the reports of so many batches.
ALL_REPORTS = {"spark.sql.streaming.numRecentProgressUpdates": "100000"}


def state_table(
    spark: SparkSession,
    checkpoint: str,
    batch: int | None = None,
    variable: str | None = None,
    operator: int | None = None,
) -> DataFrame:
    """All state rows (``key``, ``value``, ``partition_id``), now or after a batch."""
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    if operator is not None:
        reader = reader.option("operatorId", operator)
    return reader.load(checkpoint)


def state_range(state: DataFrame, key: str, low, high) -> DataFrame:
    """State rows whose key field lies in a range, both ends included."""
    return state.filter(F.col(f"key.{key}").between(low, high))


def state_changes(
    spark: SparkSession, checkpoint: str, first: int, last: int | None = None
) -> DataFrame:
    """Puts and removals of the batches ``first`` to ``last``."""
    reader = (
        spark.read.format("statestore")
        .option("readChangeFeed", "true")
        .option("changeStartBatchId", first)
    )
    if last is not None:
        reader = reader.option("changeEndBatchId", last)
    return reader.load(checkpoint)


def state_catalog(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint and their stores."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_metrics(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per batch and stateful operator of a query, since it started.

    Spark keeps a limited number of reports, 100 unless the stream was started with
    ``ALL_REPORTS`` or another limit; once earlier ones are gone this is an error.
    """
    reports = query.recentProgress
    limit = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    if len(reports) >= limit and reports[0]["batchId"] > 0:
        raise ValueError(f"only the last {len(reports)} reports are left, from batch {reports[0]['batchId']} on")
    rows = [
        (
            progress["batchId"],
            number,
            operator["operatorName"],
            operator["numRowsTotal"],
            operator["numRowsUpdated"],
            operator["numRowsRemoved"],
            operator["memoryUsedBytes"],
        )
        for progress in reports
        for number, operator in enumerate(progress["stateOperators"])
    ]
    return spark.createDataFrame(
        rows,
        "batch_id long, operator int, operator_name string, rows_total long, "
        "rows_updated long, rows_removed long, memory_bytes long",
    )


def watermark_history(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per batch: the watermark in force, and the one recorded at its end.

    A checkpoint keeps the records of ``spark.sql.streaming.minBatchesToRetain`` batches (100);
    if earlier ones are gone this is an error.
    """
    in_force = _records(spark, f"{checkpoint}/offsets", "batchWatermarkMs")
    first = in_force.agg(F.min("batch_id")).first()[0]
    if first:
        raise ValueError(f"the checkpoint has no records of the batches before {first}")
    after = _records(spark, f"{checkpoint}/commits", "nextBatchWatermarkMs")
    return in_force.withColumnRenamed("ms", "watermark_ms").join(
        after.withColumnRenamed("ms", "next_watermark_ms"), "batch_id", "left"
    )


def _records(spark: SparkSession, folder: str, field: str) -> DataFrame:
    lines = spark.read.text(folder, pathGlobFilter="[0-9]*").select(
        F.regexp_extract("_metadata.file_name", r"(\d+)$", 1).cast("long").alias("batch_id"),
        F.get_json_object("value", f"$.{field}").cast("long").alias("ms"),
    )
    return lines.filter("ms is not null")


def state_timers(
    spark: SparkSession, checkpoint: str, batch: int | None = None, operator: int | None = None
) -> DataFrame:
    """Timers that keys have registered (``key``, ``expires_ms``), now or after a batch."""
    reader = spark.read.format("statestore").option("readRegisteredTimers", "true")
    if batch is not None:
        reader = reader.option("batchId", batch)
    if operator is not None:
        reader = reader.option("operatorId", operator)
    return reader.load(checkpoint).withColumnRenamed("expiration_timestamp_ms", "expires_ms")
