"""Queries about grouped state, partition-local groups and partition hooks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    flat_map_groups,
    group_by_key,
    map_groups,
    map_partitions,
    map_partitions_summed,
    pre_aggregate,
    with_watermark,
)
from ..session import new_folder, settings, state_settings
from ..sources import read_manifest
from ..streaming.checkpoints import state_table
from ..streaming.running import into_table, run_available, run_once, run_steps
from .inputs import DECADE_SQL, events, events_stream, log_folder, log_stream, parsed
from .registry import query

COUNTS_SQL = "select user_id, count(*) as n from events group by user_id"
STEPS_SQL = f"""
    with steps as (
        select user_id, {DECADE_SQL} as step, count(*) as n from events group by all)
"""


def _add_counts(key, chunks, state):
    """Keep the number of rows of a key; emit it whenever it grew."""
    n = state.get[0] if state.exists else 0
    n += sum(int(chunk["n"].sum()) for chunk in chunks)
    state.update((n,))
    yield pd.DataFrame({"user_id": [key[0]], "n": [n]})


def _user_counts(rows: DataFrame) -> DataFrame:
    """Counts per task and user, so that a busy user reaches its task as few rows."""
    return pre_aggregate(rows, ["user_id"], {"n": ("event_id", "count")})


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(log_stream(spark, sf_dir, "decades"))


@query("select user_id % 10 as k, count(*) as n from events group by k")
def group_by_computed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group by a key that is computed from each row."""
    rows = events(spark, sf_dir).select("user_id")
    return group_by_key(rows, "k", F.col("user_id") % 10).agg(F.count("*").alias("n"))


@query(COUNTS_SQL)
def flatmap_state_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateful groups in append mode over the table as one micro-batch."""
    counts = flat_map_groups(
        _user_counts(events_stream(spark, sf_dir)),
        ["user_id"],
        _add_counts,
        "user_id long, n long",
        "n long",
    )
    out = new_folder(spark, "out")
    with settings(spark, state_settings(spark)):
        run_available(into_table(counts, out), new_folder(spark, "checkpoint"))
    return spark.read.parquet(out).select("user_id", "n")


@query(
    STEPS_SQL
    + """
    select dense_rank() over (order by step) - 1 as batch_id, user_id,
           (sum(n) over (partition by user_id order by step))::bigint as n
    from steps
    """
)
def flatmap_state_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts of the users that had data, after each micro-batch."""
    counts = flat_map_groups(
        _user_counts(_steps(spark, sf_dir)),
        ["user_id"],
        _add_counts,
        "user_id long, n long",
        "n long",
        mode="update",
    )
    out = new_folder(spark, "out")
    with settings(spark, state_settings(spark)):
        run_steps(into_table(counts, out, "update"), new_folder(spark, "checkpoint"))
    return spark.read.parquet(out).select(F.col("batch_id").cast("long"), "user_id", "n")


@query(COUNTS_SQL)
def map_state_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and micro-batch; the last one counts."""
    counts = map_groups(
        _user_counts(_steps(spark, sf_dir)),
        ["user_id"],
        _add_counts,
        "user_id long, n long",
        "n long",
    )
    out = new_folder(spark, "out")
    with settings(spark, state_settings(spark)):
        run_steps(into_table(counts, out, "update"), new_folder(spark, "checkpoint"))
    rows = spark.read.parquet(out)
    return rows.groupBy("user_id").agg(F.max_by("n", F.col("batch_id").cast("long")).alias("n"))


@query(
    """
    select user_id, count(*) as n, min(event_id) as first_id, max(event_id) as last_id
    from events group by user_id
    """
)
def flatmap_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The function of a stateful group on a table: one call per group."""

    def summary(key, chunks, state):
        for chunk in chunks:
            n, low, high = chunk["n"].sum(), chunk["first_id"].min(), chunk["last_id"].max()
            if state.exists:
                n0, low0, high0 = state.get
                n, low, high = n + n0, min(low, low0), max(high, high0)
            state.update((int(n), int(low), int(high)))
        n, low, high = state.get
        yield pd.DataFrame(
            {"user_id": [key[0]], "n": [n], "first_id": [low], "last_id": [high]}
        )

    partial = pre_aggregate(
        events(spark, sf_dir),
        ["user_id"],
        {
            "n": ("event_id", "count"),
            "first_id": ("event_id", "min"),
            "last_id": ("event_id", "max"),
        },
    )
    output = "user_id long, n long, first_id long, last_id long"
    return flat_map_groups(
        partial, ["user_id"], summary, output, "n long, first_id long, last_id long"
    )


GAP_MS = 6 * 3_600_000
DELAY_MS = 3_600_000


@query(
    f"""
    with users as (
        select user_id, count(*) as n, max(epoch_us(ts) // 1000) as last_ms
        from events group by user_id)
    select user_id, n, false as closed from users
    union all
    select user_id, n, true from users
    where last_ms + {GAP_MS} < (select max(last_ms) from users) - {DELAY_MS}
    """
)
def timeout_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that stay quiet for six hours of event time are closed."""

    def watch(key, chunks, state):
        if state.hasTimedOut:
            yield pd.DataFrame({"user_id": [key[0]], "n": [state.get[0]], "closed": [True]})
            state.remove()
            return
        n, last = state.get if state.exists else (0, 0)
        for chunk in chunks:
            n += int(chunk["n"].sum())
            # Nanoseconds since 1970, floored to milliseconds.
            times = chunk["ts"].dt.tz_localize(None).astype("datetime64[us]").astype("int64")
            last = max(last, int(times.max()) // 1000)
        state.update((n, last))
        state.setTimeoutTimestamp(last + GAP_MS)
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "closed": [False]})

    # All rows come in the first batch, when no row is late yet, so they may be
    # merged first; the largest time of a user is what the watermark needs.
    partial = pre_aggregate(
        events_stream(spark, sf_dir),
        ["user_id"],
        {"n": ("event_id", "count"), "ts": ("ts", "max")},
    )
    watched = flat_map_groups(
        with_watermark(partial, "ts", "1 hour"),
        ["user_id"],
        watch,
        "user_id long, n long, closed boolean",
        "n long, last_ms long",
        timeout="event",
    )
    out = new_folder(spark, "out")
    with settings(spark, state_settings(spark)):
        run_available(into_table(watched, out), new_folder(spark, "checkpoint"))
    return spark.read.parquet(out).select("user_id", "n", "closed")


@query(
    STEPS_SQL
    + """,
    ranked as (
        select *, dense_rank() over (order by step) as b from steps),
    runs as (
        select *, b - row_number() over (partition by user_id order by b) as run from ranked)
    select user_id, (sum(n) over (partition by user_id, run order by b))::bigint as n,
           false as closed
    from runs
    union all
    select user_id, sum(n)::bigint, true from runs group by user_id, run
    """
)
def timeout_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user without data in the next micro-batch is closed in it.

    The time limit is one millisecond, so whoever is absent from a batch is
    over it; the last step brings no rows and closes everybody left.
    """

    def watch(key, chunks, state):
        if state.hasTimedOut:
            yield pd.DataFrame({"user_id": [key[0]], "n": [state.get[0]], "closed": [True]})
            state.remove()
            return
        n = state.get[0] if state.exists else 0
        n += sum(int(chunk["n"].sum()) for chunk in chunks)
        state.update((n,))
        state.setTimeoutDuration(1)
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "closed": [False]})

    out, checkpoint = new_folder(spark, "out"), new_folder(spark, "checkpoint")
    history = new_folder(spark, "history")
    steps = read_manifest(spark, f"{log_folder(spark, sf_dir, 'closing')}/manifest")
    with settings(spark, state_settings(spark)):
        for _ in range(steps.select("offset").distinct().count()):
            stream = log_stream(spark, sf_dir, "closing", historyPath=history)
            watched = flat_map_groups(
                _user_counts(parsed(stream)),
                ["user_id"],
                watch,
                "user_id long, n long, closed boolean",
                "n long",
                mode="update",
                timeout="processing",
            )
            run_once(into_table(watched, out, "update"), checkpoint)
    return spark.read.parquet(out).select("user_id", "n", "closed")


@query(
    STEPS_SQL
    + f""",
    ends as (
        select user_id, {DECADE_SQL} as step, arg_max(event_type, event_id) as last_type
        from events group by all),
    removed as (
        select user_id, max(step) as step from ends where last_type = 'purchase' group by user_id)
    select s.user_id, sum(s.n)::bigint as n
    from steps s left join removed r on s.user_id = r.user_id
    where r.step is null or s.step > r.step group by s.user_id
    """
)
def state_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State is removed by a batch that ends with a purchase, updated otherwise."""

    def keep(key, chunks, state):
        n = state.get[0] if state.exists else 0
        last = last_purchase = -1
        for chunk in chunks:
            n += int(chunk["n"].sum())
            last = max(last, int(chunk["last_id"].max()))
            last_purchase = max(last_purchase, int(chunk["purchase_id"].max()))
        if last == last_purchase:
            state.remove()
        else:
            state.update((n,))
        yield pd.DataFrame({"user_id": [key[0]]})

    bought = F.when(F.col("event_type") == "purchase", F.col("event_id")).otherwise(-1)
    partial = pre_aggregate(
        _steps(spark, sf_dir).withColumn("bought", bought),
        ["user_id"],
        {
            "n": ("event_id", "count"),
            "last_id": ("event_id", "max"),
            "purchase_id": ("bought", "max"),
        },
    )
    kept = flat_map_groups(partial, ["user_id"], keep, "user_id long", "n long", mode="update")
    checkpoint = new_folder(spark, "checkpoint")
    with settings(spark, state_settings(spark)):
        run_steps(into_table(kept, new_folder(spark, "out"), "update"), checkpoint)
    state = state_table(spark, checkpoint)
    return state.select("key.user_id", F.col("value.groupState.n").alias("n"))


@query(
    """
    select user_id, count(*) as n, min(event_id) as first_id, max(event_id) as last_id
    from events group by user_id
    """
)
def partition_local_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups formed where the rows already are, then merged.

    Neither shuffle nor sort comes before the fold; only the few rows per
    partition and user are exchanged to merge users met in several partitions.
    Each task folds its rows batch by batch, by columns, so a chunk costs the
    same whether it holds few users or many.
    """
    rows = events(spark, sf_dir).select("user_id", "event_id").withColumn("one", F.lit(1))
    partial = pre_aggregate(
        rows,
        ["user_id"],
        {
            "n": ("one", "count"),
            "first_id": ("event_id", "min"),
            "last_id": ("event_id", "max"),
        },
    )
    return partial.groupBy("user_id").agg(
        F.sum("n").alias("n"), F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id")
    )


@query("select event_id, upper(event_type) as kind, event_id * 2 as twice from events")
def map_partitions_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function over whole partitions."""

    def project(chunks):
        for chunk in chunks:
            yield pd.DataFrame(
                {
                    "event_id": chunk["event_id"],
                    "kind": chunk["event_type"].str.upper(),
                    "twice": chunk["event_id"] * 2,
                }
            )

    rows = events(spark, sf_dir).select("event_id", "event_type")
    return map_partitions(rows, project, "event_id long, kind string, twice long")


@query("select count(*) as n, 0 as failed from events having count(*) > 0")
def partition_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that partitions had produced by their own count when they ended, and how many
    partitions have no count at their end or another one than there are rows."""

    def count(chunks, totals):
        totals["produced"] = 0
        for chunk in chunks:
            totals["produced"] += len(chunk)
            yield chunk

    rows = events(spark, sf_dir).select("event_id")
    done = map_partitions_summed(rows, count, "event_id long", "produced long")
    parts = done.groupBy("partition", "attempt").agg(
        F.count_if(~F.col("is_summary")).alias("n"), F.sum("produced").alias("produced")
    )
    return parts.agg(
        F.sum("produced").alias("n"),
        F.count_if(F.col("n") != F.coalesce("produced", F.lit(0))).cast("int").alias("failed"),
    )
