"""Queries about watermarks and late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    SINGLE_WATERMARK,
    combined,
    flat_map_groups,
    policy_setting,
    watermark_audit,
    with_watermark,
)
from ..session import new_folder, settings, state_settings
from ..streaming.checkpoints import watermark_history as history_of
from ..streaming.running import into_table, run_available, run_steps
from .inputs import ARRIVAL_BLOCK_SQL, ARRIVAL_DAY_SQL, arrival_day, events, events_stream, log_stream, parsed
from .registry import query

HOUR_MS = 3_600_000
DELAY_HOURS = 36

AUDIT_SQL = f"""
    with arrived as (select event_id, ts, {{arrival}} as arrival from events),
    batches as (
        select arrival, row_number() over (order by arrival) - 1 as batch_id,
               count(*) as n, max(epoch_us(ts) // 1000) as max_ms
        from arrived group by arrival),
    bounds as (
        select *, greatest(0, coalesce(max(max_ms) over (
                order by arrival rows between unbounded preceding and 1 preceding)
            - {DELAY_HOURS * HOUR_MS}, 0)) as watermark_ms
        from batches)
"""
AUDIT_DAYS_SQL = AUDIT_SQL.format(arrival=ARRIVAL_DAY_SQL)
AUDIT_BLOCKS_SQL = AUDIT_SQL.format(arrival=ARRIVAL_BLOCK_SQL)


@query(
    AUDIT_DAYS_SQL
    + """
    select epoch_ms(b.arrival::timestamp) as arrival_ms, any_value(b.n) as n,
           any_value(b.max_ms) as max_ms, any_value(b.watermark_ms) as watermark_ms,
           count(*) filter (epoch_us(a.ts) <= b.watermark_ms * 1000) as late
    from arrived a join bounds b on a.arrival = b.arrival group by b.arrival
    """
)
def watermark_audit_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per arrival day: the watermark in force and how many rows are late."""
    arrived = events(spark, sf_dir).select("ts", arrival_day().alias("arrival"))
    audit = watermark_audit(arrived, "arrival", "ts", DELAY_HOURS * HOUR_MS)
    return audit.select(
        F.unix_millis(F.col("arrival").cast("timestamp")).alias("arrival_ms"),
        "n",
        "max_ms",
        "watermark_ms",
        "late",
    )


@query(AUDIT_BLOCKS_SQL + "select batch_id, watermark_ms from bounds")
def watermark_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermarks that a stream over the arrival blocks recorded by itself."""
    stream = with_watermark(
        parsed(log_stream(spark, sf_dir, "arrivals")), "ts", f"{DELAY_HOURS} hours"
    )
    checkpoint = new_folder(spark, "checkpoint")
    run_steps(into_table(stream, new_folder(spark, "out")), checkpoint)
    return history_of(spark, checkpoint).select("batch_id", "watermark_ms")


def late_rows_kept(stream: DataFrame, function) -> DataFrame:
    """The rows of a stream that a stateful operator with event-time timeouts lets through.

    The operator drops late rows one by one, whatever their key, and the function keeps no
    state of a user; so the rows are grouped by a bucket of the user, as many buckets as
    shuffle partitions, and a micro-batch makes that many calls at most, however many users.
    """
    buckets = int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return flat_map_groups(
        stream.withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets))),
        ["bucket"],
        function,
        "event_id long",
        "n long",
        timeout="event",
    )


@query(
    AUDIT_BLOCKS_SQL
    + """
    select a.event_id from arrived a join bounds b on a.arrival = b.arrival
    where epoch_us(a.ts) > b.watermark_ms * 1000
    """
)
def late_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What reaches a stateful operator with event-time timeouts."""

    def keep(key, chunks, state):
        for chunk in chunks:
            yield chunk[["event_id"]]

    stream = with_watermark(
        parsed(log_stream(spark, sf_dir, "arrivals")), "ts", f"{DELAY_HOURS} hours"
    )
    kept = late_rows_kept(stream.select("user_id", "event_id", "ts"), keep)
    out = new_folder(spark, "out")
    with settings(spark, state_settings(spark, **SINGLE_WATERMARK)):
        run_steps(into_table(kept, out), new_folder(spark, "checkpoint"))
    return spark.read.parquet(out).select("event_id")


@query(
    """
    select epoch_ms(ts::date::timestamp) as day_ms, count(*) as n from events group by ts::date
    """
)
def watermark_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A streaming count per day behind a watermark."""
    counts = (
        with_watermark(events_stream(spark, sf_dir).select("ts"), "ts", "1 hour")
        .groupBy(F.unix_millis(F.date_trunc("day", "ts")).alias("day_ms"))
        .agg(F.count("*").alias("n"))
    )
    out = new_folder(spark, "out")
    with settings(spark, state_settings(spark)):
        run_available(into_table(counts, out, "update"), new_folder(spark, "checkpoint"))
    return spark.read.parquet(out).select("day_ms", "n")


def _two_inputs(spark: SparkSession, sf_dir: str, policy: str, second: str) -> DataFrame:
    def one(kind: str, delay: str) -> DataFrame:
        rows = events_stream(spark, sf_dir).select("ts", "event_type")
        return with_watermark(rows.filter(F.col("event_type") == kind), "ts", delay)

    both = one("view", "1 hour").unionByName(one(second, "3 hours"))
    checkpoint = new_folder(spark, "checkpoint")
    with settings(spark, policy_setting(policy)):
        run_available(into_table(both, new_folder(spark, "out")), checkpoint)
    return (
        history_of(spark, checkpoint)
        .agg(F.max("next_watermark_ms").alias("watermark_ms"))
        .select(F.lit(policy).alias("policy"), "watermark_ms")
    )


MAX_SQL = "(select max(epoch_us(ts) // 1000) from events where event_type = '{}')"
TWO_SQL = f"{MAX_SQL.format('view')} - {HOUR_MS}, {MAX_SQL.format('click')} - {3 * HOUR_MS}"


@query(
    f"""
    select 'min' as policy, least({TWO_SQL}) as watermark_ms
    union all select 'max', greatest({TWO_SQL})
    """
)
def watermark_two_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The global watermark of two streams under both policies."""
    return _two_inputs(spark, sf_dir, "min", "click").unionByName(
        _two_inputs(spark, sf_dir, "max", "click")
    )


@query(
    f"""
    select 'min' as policy, least({TWO_SQL}) as watermark_ms
    union all select 'max', greatest({TWO_SQL})
    """
)
def watermark_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same computed from the table."""

    def limit(kind: str, hours: int):
        time = F.when(F.col("event_type") == kind, F.unix_millis(F.col("ts").cast("timestamp")))
        return F.max(time) - hours * HOUR_MS

    ends = events(spark, sf_dir).agg(limit("view", 1).alias("a"), limit("click", 3).alias("b"))
    columns = [F.col("a"), F.col("b")]
    return ends.select(
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(policy).alias("policy"),
                        combined(columns, policy).alias("watermark_ms"),
                    )
                    for policy in ("min", "max")
                )
            )
        ).alias("row")
    ).select("row.*")


@query("select 'min' as policy, 0::bigint as watermark_ms from events having count(*) > 0")
def watermark_idle_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An input that never has data holds the global watermark at zero."""
    return _two_inputs(spark, sf_dir, "min", "no such type")
