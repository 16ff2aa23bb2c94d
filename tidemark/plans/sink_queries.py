"""Queries through the append sink, its ledger and its expiry."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_duration
from ..session import new_folder
from ..streaming.append_sink import (
    AppendSink,
    appended,
    compact,
    compact_new,
    compacted,
    expire,
    flag_batches,
    ledger_table,
    retained,
)
from ..streaming.running import run_available, run_steps
from .inputs import DECADE_SQL, LINE_SQL, event_line, events_stream, log_stream, parsed
from .registry import query

ROUTED_SQL = f"""
    select dense_rank() over (order by {DECADE_SQL}) - 1 as batch_id,
           event_type as out_path, {LINE_SQL} as value
    from events
"""


def _sink(root: str, **options) -> AppendSink:
    return AppendSink(
        root, F.col("event_type"), event_line(), order=[F.col("event_id")], **options
    )


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(log_stream(spark, sf_dir, "decades"))


@query(ROUTED_SQL)
def append_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event goes to the path of its type, batch by batch."""
    root = new_folder(spark, "sink")
    run_steps(_sink(root).stream(_rows(spark, sf_dir)), new_folder(spark, "checkpoint"))
    return appended(spark, root).select("batch_id", "out_path", "value")


@query(
    f"""
    select event_type as out_path, {LINE_SQL} as value from events
    where event_type <> 'error' and "value" >= 5
    """
)
def append_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a path (errors) or without a text (small values) are left out."""
    root = new_folder(spark, "sink")
    path = F.when(F.col("event_type") != "error", F.col("event_type"))
    text = F.when(F.col("value") >= 5, event_line())
    sink = AppendSink(root, path, text)
    run_available(sink.stream(events_stream(spark, sf_dir)), new_folder(spark, "checkpoint"))
    return appended(spark, root).select("out_path", "value")


@query(ROUTED_SQL)
def append_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch is offered again: once after a failure between start and
    done, once after success.  The rows are there once."""
    root = new_folder(spark, "sink")
    sink = _sink(root)
    broken = AppendSink(
        root,
        F.concat("event_type", F.lit("-partial")),
        F.when(F.col("event_id") % 2 == 0, F.lit("half")),
        clock=_fails_at_done(),
    )

    def batch(rows: DataFrame, batch_id: int) -> None:
        try:
            broken.write_batch(rows, batch_id)
        except ConnectionError:
            pass
        if not sink.write_batch(rows, batch_id):
            raise RuntimeError("a batch without a done record was skipped")
        if sink.write_batch(rows, batch_id):
            raise RuntimeError("a finished batch was written again")

    stream = _rows(spark, sf_dir)
    run_steps(stream.writeStream.foreachBatch(batch), new_folder(spark, "checkpoint"))
    return appended(spark, root).select("batch_id", "out_path", "value")


def _fails_at_done():
    """A clock that works for the start record and fails for the done record."""
    calls = [0]

    def clock() -> datetime:
        calls[0] += 1
        if calls[0] % 2 == 0:
            raise ConnectionError("lost while writing the done record")
        return datetime(2024, 1, 1, tzinfo=UTC)

    return clock


@query(
    """
    select event_type as out_path, count(*) as n, min(event_id) as first_id,
           max(event_id) as last_id
    from events group by event_type
    """
)
def append_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches of each path put together into few files."""
    root, target = new_folder(spark, "sink"), new_folder(spark, "compact")
    run_steps(_sink(root).stream(_rows(spark, sf_dir)), new_folder(spark, "checkpoint"))
    compact(spark, root, target)
    event_id = F.split("value", r"\|")[0].cast("long")
    return (
        spark.read.schema("value string, out_path string")
        .text(target)
        .groupBy("out_path")
        .agg(
            F.count("*").alias("n"),
            F.min(event_id).alias("first_id"),
            F.max(event_id).alias("last_id"),
        )
    )


@query(
    f"""
    with routed as ({ROUTED_SQL.replace("event_type as out_path", "event_id, event_type as out_path")})
    select case when batch_id <= 1 then 0 else 2 end::bigint as generation, out_path, value,
           row_number() over (partition by out_path order by batch_id, event_id) - 1 as line
    from routed
    """
)
def append_compact_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compacted after the second batch and at the end, each time what is new; every line's place."""
    root, target = new_folder(spark, "sink"), new_folder(spark, "compact")
    sink = _sink(root)

    def batch(rows: DataFrame, batch_id: int) -> None:
        sink.write_batch(rows, batch_id)
        if batch_id == 1:
            compact_new(spark, root, target)

    stream = _rows(spark, sf_dir)
    run_steps(stream.writeStream.foreachBatch(batch), new_folder(spark, "checkpoint"))
    compact_new(spark, root, target)
    return compacted(spark, target)


@query(
    f"""
    with batches as (select distinct {DECADE_SQL} as step from events),
    numbered as (select row_number() over (order by step) - 1 as batch_id from batches)
    select batch_id, status from numbered, (values ('start'), ('done')) as s(status)
    where batch_id >= (select max(batch_id) from numbered) - 1
    """
)
def append_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after all batches, with records kept for one batch back."""
    root = new_folder(spark, "sink")
    run_steps(
        _sink(root, keep=1).stream(_rows(spark, sf_dir)), new_folder(spark, "checkpoint")
    )
    return ledger_table(spark, root).select("batch_id", "status")


@query(
    f"""
    with routed as ({ROUTED_SQL})
    select * from routed where batch_id >= 2
    """
)
def append_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output lives for a day and two hours; a day passes between batches."""
    root = new_folder(spark, "sink")
    times = [datetime(2024, 1, 1, tzinfo=UTC)]

    def batch(rows: DataFrame, batch_id: int) -> None:
        now = times[0] + timedelta(days=batch_id)
        _sink(root, expiry="1.02:00:00", clock=lambda: now).write_batch(rows, batch_id)

    stream = _rows(spark, sf_dir)
    run_steps(stream.writeStream.foreachBatch(batch), new_folder(spark, "checkpoint"))
    expire(spark, root, times[0] + timedelta(days=2, hours=12))
    return appended(spark, root).select("batch_id", "out_path", "value")


@query(
    """
    with batches as (
        select distinct (year(o_orderdate) * 12 + month(o_orderdate))::bigint as batch_id
        from orders)
    select batch_id from batches where batch_id >= (select max(batch_id) from batches) - 24
    """
)
def ledger_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag names of the form batch_partition_status, one batch per order month."""
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    status = F.when(F.col("o_orderstatus") == "F", "done").when(
        F.col("o_orderstatus") == "O", "start"
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    names = orders.select(
        F.explode(
            F.array(
                F.concat_ws("_", month, F.col("o_custkey") % 8, F.coalesce(status, F.lit("start"))),
                F.concat(F.lit("tmp_"), F.col("o_orderkey")),
            )
        ).alias("name")
    )
    return retained(flag_batches(names, "name"), keep=24)


@query(
    """
    select o_orderkey,
           epoch_ms(o_orderdate + case o_orderpriority
               when '1-URGENT' then interval '2' hour + interval '30' minute
               when '2-HIGH' then interval '1' day
               when '3-MEDIUM' then interval '36' hour + interval '5' second
               when '4-NOT SPECIFIED' then interval '10' day + interval '1' second
               end) as expires_ms
    from orders
    """
)
def output_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expiry times from durations as text; other text gives no expiry."""
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", "2:30:00")
        .when(priority == "2-HIGH", "1.00:00:00")
        .when(priority == "3-MEDIUM", "1.12:00:05")
        .when(priority == "4-NOT SPECIFIED", "10.0:00:01")
        .otherwise("never")
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    expires = F.col("o_orderdate").cast("timestamp") + parse_duration(text)
    return orders.select("o_orderkey", F.unix_millis(expires).alias("expires_ms"))
