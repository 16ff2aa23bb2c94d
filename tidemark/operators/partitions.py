"""Functions over whole partitions, with a hook at the end of the task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import arrow_schema, session_zone, to_batch, to_frame

PartitionFunction = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
SummedFunction = Callable[[Iterator[pd.DataFrame], dict], Iterator[pd.DataFrame]]
# Called with the partition number and whether all of its output was produced.
Hook = Callable[[int, bool], None]


def map_partitions(
    df: DataFrame,
    function: PartitionFunction,
    output: str,
    on_complete: Hook | None = None,
) -> DataFrame:
    """Apply a function to each partition as an iterator of pandas chunks.

    ``on_complete`` runs in the task when the partition ends, after success,
    failure or an early stop alike, also for a partition without rows.  A task
    that Spark repeats calls it again.  An empty partition never reaches the
    function.  Whole numbers with nulls have pandas' nullable types.
    """
    schema, zone = arrow_schema(output), session_zone(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = (to_frame(batch, zone) for batch in batches)
        finished = False
        try:
            chunk = next((c for c in chunks if len(c)), None)
            if chunk is not None:
                for frame in function(_from(chunk, chunks)):
                    yield to_batch(frame, schema, zone)
            finished = True
        finally:
            if on_complete is not None:
                on_complete(TaskContext.get().partitionId(), finished)

    return df.mapInArrow(run, output)


def _from(first: pd.DataFrame, rest: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield first
    yield from rest


def map_partitions_summed(df: DataFrame, function: SummedFunction, output: str, summary: str) -> DataFrame:
    """Like ``map_partitions``, with one more row at the end of each partition: its summary.

    The function is also given a dictionary, in which it puts values for the columns of
    ``summary``.  After its columns each row has ``partition`` and ``attempt``, the numbers of
    the partition and of the task, and ``is_summary``.  Rows of the function have null in
    the summary's columns, summaries in those of the output.  A partition without rows has a summary
    of nulls.  Summaries are rows of the plan: an attempt that failed leaves none, and one
    that Spark repeats is counted once wherever its rows are.
    """
    rows_schema, sums_schema, zone = arrow_schema(output), arrow_schema(summary), session_zone(df.sparkSession)
    place = arrow_schema("partition int, attempt long, is_summary boolean")
    columns = [*rows_schema, *sums_schema, *place]
    names = [column.name for column in columns]
    if len({name.lower() for name in names}) < len(names):
        raise ValueError(f"columns of output, summary and place must differ: {names}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        here = {"partition": context.partitionId(), "attempt": context.taskAttemptId()}

        def filled(given: dict[str, pa.Array], values: dict, n: int) -> pa.RecordBatch:
            arrays = [
                given[c.name] if c.name in given else pa.array([values.get(c.name)] * n, c.type) for c in columns
            ]
            return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(columns))

        totals: dict = {}
        chunks = (to_frame(batch, zone) for batch in batches)
        chunk = next((c for c in chunks if len(c)), None)
        if chunk is not None:
            for frame in function(_from(chunk, chunks), totals):
                batch = to_batch(frame, rows_schema, zone)
                given = dict(zip(rows_schema.names, batch.columns))
                yield filled(given, here | {"is_summary": False}, batch.num_rows)
        unknown = set(totals) - set(sums_schema.names)
        if unknown:
            raise ValueError(f"not in the summary: {sorted(unknown)}")
        yield filled({}, totals | here | {"is_summary": True}, 1)

    return df.mapInArrow(run, f"{output}, {summary}, partition int, attempt long, is_summary boolean")


def committed(summed: DataFrame) -> DataFrame:
    """The rows of one finished attempt for each partition: the last one that has a summary.

    For rows that came through a store without commit, where several attempts of a task
    may have left rows.  There is one row a partition on the smaller side.
    """
    ended = summed.filter("is_summary").groupBy("partition").agg(F.max("attempt").alias("attempt"))
    return summed.join(ended, ["partition", "attempt"], "left_semi").select(*summed.columns)
