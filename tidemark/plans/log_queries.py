"""Queries over the batch log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder
from ..sources import (
    RecordingReader,
    acknowledged_table,
    for_each_log_batch,
    history_table,
    only_new,
    read_batch_log,
    read_manifest,
    register,
)
from ..streaming.running import into_table, run_steps
from .inputs import DECADE_SQL, LINE_SQL, log_folder, log_stream, tables_log
from .registry import query

FIRST = "(select min(ts::date) from events)"
LAST = "(select max(ts::date) from events)"
LOG_ROWS_SQL = f"""
    select 'events' as name,
           case when ts::date = {FIRST} then 0 else epoch_ms(ts::date::timestamp) end as cti_ms,
           {LINE_SQL} as value
    from events where ts::date < {LAST}
"""


def _with_ms(rows: DataFrame) -> DataFrame:
    return rows.select("name", F.unix_millis("cti").alias("cti_ms"), "value")


@query(LOG_ROWS_SQL)
def batchlog_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps of the day log in one batch read."""
    root = log_folder(spark, sf_dir, "days")
    return _with_ms(read_batch_log(spark, read_manifest(spark, f"{root}/manifest")))


@query(LOG_ROWS_SQL)
def batchlog_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows through the streaming source, one step per micro-batch."""
    out = new_folder(spark, "out")
    run_steps(into_table(log_stream(spark, sf_dir, "days"), out), new_folder(spark, "checkpoint"))
    return _with_ms(spark.read.parquet(out))


@query(
    f"""
    select 'events' as name, epoch_ms({DECADE_SQL}::timestamp) as cti_ms, {LINE_SQL} as value
    from events
    """
)
def batchlog_native_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log in steps of ten days: the stream carries entries, Spark scans the text."""
    out = new_folder(spark, "out")

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    entries = log_stream(spark, sf_dir, "closing", content="entries")
    run_steps(for_each_log_batch(entries, write), new_folder(spark, "checkpoint"))
    return _with_ms(spark.read.parquet(out))


@query(
    """
    select row_number() over (order by ts::date) - 1 as step,
           epoch_ms(ts::date::timestamp) as day_ms, count(*) as n
    from events group by ts::date
    """
)
def batchlog_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One step per micro-batch: which batch brought which day."""
    out = new_folder(spark, "out")
    run_steps(into_table(log_stream(spark, sf_dir, "ready_days"), out), new_folder(spark, "checkpoint"))
    line_time = F.timestamp_micros(F.split("value", r"\|")[3].cast("long"))
    return (
        spark.read.parquet(out)
        .groupBy(
            F.col("batch_id").cast("long").alias("step"),
            F.unix_millis(F.date_trunc("day", line_time)).alias("day_ms"),
        )
        .agg(F.count("*").alias("n"))
    )


@query(
    """
    select epoch_ms(ts::date::timestamp) as day_ms, (event_id % 3)::int as part, count(*) as n
    from events group by all
    """
)
def batchlog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per entry and entry partition."""
    root = log_folder(spark, sf_dir, "ready_days")
    rows = read_batch_log(
        spark, read_manifest(spark, f"{root}/manifest"), with_partition=True
    )
    line_time = F.timestamp_micros(F.split("value", r"\|")[3].cast("long"))
    return rows.groupBy(
        F.unix_millis(F.date_trunc("day", line_time)).alias("day_ms"),
        F.col("partition").alias("part"),
    ).agg(F.count("*").alias("n"))


@query(
    f"""
    select epoch_ms({DECADE_SQL}::timestamp) as cti_ms, (event_id % 3)::int as part, count(*) as n
    from events group by all
    """
)
def batchlog_stream_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per entry and entry partition through a stream of entries, counted batch by batch."""
    out = new_folder(spark, "out")

    def count(rows: DataFrame, batch_id: int) -> None:
        counts = rows.groupBy(F.unix_millis("cti").alias("cti_ms"), F.col("partition").alias("part"))
        counts.agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    entries = log_stream(spark, sf_dir, "decades", content="entries")
    run_steps(for_each_log_batch(entries, count, with_partition=True), new_folder(spark, "checkpoint"))
    return spark.read.parquet(out).drop("batch_id")


@query(
    f"""
    select form, epoch_ms({DECADE_SQL}::timestamp) as cti_ms, {LINE_SQL} as value
    from events, (values ('batch'), ('stream')) forms (form)
    """
)
def batchlog_compressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of compressed files in both forms."""
    out = new_folder(spark, "out")
    run_steps(into_table(log_stream(spark, sf_dir, "packed"), out), new_folder(spark, "checkpoint"))
    root = log_folder(spark, sf_dir, "packed")
    forms = {
        "batch": read_batch_log(spark, read_manifest(spark, f"{root}/manifest")),
        "stream": spark.read.parquet(out),
    }
    both = [_with_ms(rows).select(F.lit(form).alias("form"), "cti_ms", "value") for form, rows in forms.items()]
    return both[0].unionByName(both[1])


HISTORY_SQL = f"""
    select row_number() over (order by d) - 1 as "offset", 'events' as name,
           epoch_ms(d::timestamp) as cti_ms, 3 as partitions,
           d = {FIRST} as is_snapshot, d < {LAST} as is_ready
    from (select distinct ts::date as d from events)
"""


def _history(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    path = new_folder(spark, "history")
    stream = log_stream(spark, sf_dir, "days", historyPath=path, **options)
    run_steps(into_table(stream, new_folder(spark, "out")), new_folder(spark, "checkpoint"))
    return history_table(spark, path).drop("path")


@query(HISTORY_SQL)
def batchlog_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the source wrote down about each offset."""
    return _history(spark, sf_dir)


@query(
    f"""
    with history as ({HISTORY_SQL})
    select * from history where "offset" >= (select max("offset") from history) - 1 - 8
    """
)
def batchlog_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with eight offsets kept.

    Spark acknowledges an offset when it plans the next batch, so the last
    acknowledged one is the one before the newest.
    """
    return _history(spark, sf_dir, minLogs="8")


@query(
    f"""
    with steps as (select distinct ts::date as d from events where ts::date < {LAST})
    select 'events' as name, epoch_ms(b.d::timestamp) as cti_ms, {LINE_SQL} as value
    from events join steps b on events.ts::date = b.d
    where b.d > (select min(d) from steps) + 9 and b.d <= (select min(d) from steps) + 19
    """
)
def batchlog_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range of steps (9, 19]: what a consumer at step 9 still has to read."""
    root = log_folder(spark, sf_dir, "days")
    manifest = read_manifest(spark, f"{root}/manifest")
    return _with_ms(read_batch_log(spark, manifest, start=9, end=19))


TABLES_SQL = f"""
    with e as (
        select {DECADE_SQL} as d, count(*) as rows from events where ts is not null group by d),
    o as (
        select date_trunc('year', o_orderdate)::date as d, count(*) as rows
        from orders where o_orderdate is not null group by d),
    entries as (
        select 'events' as name, d, rows, row_number() over (order by d) - 1 as place, 1 as pace from e
        union all
        select 'orders', d, rows, row_number() over (order by d) - 1, 2 from o),
    ranked as (select *, max(place) over (partition by name) as last from entries),
    steps as (select unnest(range((select max(place * pace) from ranked) + 1)) as k),
    sets as (
        select k, r.* from steps join ranked r on r.place = least(k // r.pace, r.last)),
    marked as (
        select *, lag(place) over (partition by name order by k) is distinct from place as fresh from sets),
    kept as (
        -- a step that repeats the whole set is none
        select *, bool_or(fresh) over (partition by k) as differs from marked)
"""
TABLES_OUT = "name, epoch_ms(d::timestamp) as cti_ms"
READY = "(name = 'events' or place < last)"


def _tables(spark: SparkSession, sf_dir: str, emit: str) -> DataFrame:
    """Rows per entry in both forms of the log of two tables."""
    root = tables_log(spark, sf_dir)
    register(spark)
    stream = (
        spark.readStream.format("batchlog")
        .option("reader", "manifest")
        .option("manifestPath", f"{root}/manifest")
        .option("historyPath", new_folder(spark, "history"))
        .option("emit", emit)
        .load()
    )
    out = new_folder(spark, "out")
    run_steps(into_table(stream, out), new_folder(spark, "checkpoint"))
    batch = read_batch_log(spark, read_manifest(spark, f"{root}/manifest"), emit=emit)
    forms = {"batch": batch, "stream": spark.read.parquet(out).select("name", "cti", "value")}
    both = [rows.select(F.lit(form).alias("form"), "name", "cti") for form, rows in forms.items()]
    counts = both[0].unionByName(both[1]).groupBy("form", "name", F.unix_millis("cti").alias("cti_ms"))
    return counts.agg(F.count("*").alias("n"))


@query(
    TABLES_SQL
    + f"""
    select form, {TABLES_OUT}, sum(rows)::bigint as n
    from kept, (values ('batch'), ('stream')) forms (form)
    where differs and {READY} group by all
    """
)
def batchlog_tables_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of two tables: every entry of each set, at each of its steps."""
    return _tables(spark, sf_dir, "set")


@query(
    TABLES_SQL
    + f"""
    select form, {TABLES_OUT}, rows as n
    from kept, (values ('batch'), ('stream')) forms (form) where fresh and {READY}
    """
)
def batchlog_tables_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log, each entry once."""
    return _tables(spark, sf_dir, "new")


@query(TABLES_SQL + f"""select k as "offset", {TABLES_OUT}, {READY} as is_ready from kept where fresh""")
def batchlog_set_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of the log adds to the set of the step before."""
    manifest = read_manifest(spark, f"{tables_log(spark, sf_dir)}/manifest")
    return only_new(manifest).select("offset", "name", F.unix_millis("cti").alias("cti_ms"), "is_ready")


STEPS_PER_BATCH = 4


@query(
    TABLES_SQL
    + f""",
    numbered as (select *, dense_rank() over (order by k) - 1 as step from kept where differs)
    select k as "offset", {TABLES_OUT}, 1::bigint as calls
    from numbered
    where step < (select max(step) from numbered) // {STEPS_PER_BATCH} * {STEPS_PER_BATCH}
    """
)
def reader_acknowledged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which entries of which steps were acknowledged to the reader, four steps a batch.

    The steps of the last batch wait: Spark reports a batch's end when it plans the next one.
    """
    register(spark, RecordingReader)
    told = new_folder(spark, "acknowledged")
    stream = (
        spark.readStream.format("batchlog")
        .option("reader", "recording")
        .option("acknowledgedPath", told)
        .option("manifestPath", f"{tables_log(spark, sf_dir)}/manifest")
        .option("historyPath", new_folder(spark, "history"))
        .option("stepsPerBatch", STEPS_PER_BATCH)
        .load()
    )
    run_steps(into_table(stream, new_folder(spark, "out")), new_folder(spark, "checkpoint"))
    return acknowledged_table(spark, told)
