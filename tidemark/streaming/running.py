"""Running streams: writing micro-batches to a table and waiting for the end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def into_table(stream: DataFrame, root: str, mode: str = "append") -> DataStreamWriter:
    """Write each micro-batch to its own folder ``root/batch_id=N``.

    The folder is replaced as a whole, so a repeated batch leaves no trace of
    the failed attempt.  Read it back with ``spark.read.parquet(root)``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return stream.writeStream.outputMode(mode).foreachBatch(write)


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process what is there now and end, with the last batch for timeouts."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_once(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Exactly one micro-batch.  A stepping source delivers one step, and a
    processing-time timeout, which would run batches for ever, ends too."""
    query = writer.option("checkpointLocation", checkpoint).trigger(once=True).start()
    query.awaitTermination()
    return query


def run_steps(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Step through a source that advances once per trigger until it stands still."""
    query = writer.option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query
