"""Timeouts in event time over many micro-batches, with late rows and keys that return."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import SINGLE_WATERMARK, flat_map_groups, pre_aggregate, time_slot, with_watermark
from ..session import new_folder, settings, state_settings
from ..streaming.running import into_table, run_steps
from .inputs import arrival_block_sql, log_stream, parsed
from .registry import query

SLOT_S = 3600
DELAY_H = 48
GAP_MS = 6 * 3_600_000

# Batches, the watermark in force in each and after the last, and per batch and key what is timely.
TIMELY_SQL = f"""
    with arrived as (
        select user_id, coalesce(event_type, '') as event_type, event_id, {arrival_block_sql(3)} as block,
               (epoch_ms(ts) // {SLOT_S * 1000} + 1) * {SLOT_S * 1000} as slot
        from events where ts is not null),
    batches as (
        select block, row_number() over (order by block) as b, max(slot) as high from arrived group by block),
    marks as (
        select b, coalesce(max(high) over (order by b rows between unbounded preceding and 1 preceding)
                           - {DELAY_H * 3_600_000}, 0) as mark,
               max(high) over (order by b) - {DELAY_H * 3_600_000} as next_mark, max(b) over () as final
        from batches),
    timely as (
        select a.user_id, a.event_type, m.b, count(*) as k, max(a.slot) as high, max(a.event_id) as last_id,
               arg_max(a.event_id % 5, a.event_id) as last_digit
        from arrived a join batches using (block) join marks m using (b)
        where a.slot > m.mark group by all)
"""


def _partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per task, key and slot, behind a watermark on slots.

    A slot is late as a whole or not at all, so the merged rows are dropped where their rows would be.
    """
    rows = parsed(log_stream(spark, sf_dir, "short_arrivals"))
    rows = rows.withColumn("slot", time_slot(F.col("ts"), SLOT_S)).where("slot is not null")
    counted = {"n": ("event_id", "count"), "last_id": ("event_id", "max")}
    partial = pre_aggregate(rows, ["user_id", "event_type", "slot"], counted)
    return with_watermark(partial, "slot", f"{DELAY_H} hours")


def _run(
    spark: SparkSession, partial: DataFrame, watch: Callable, output: str, state: str, merge: dict[str, str]
) -> DataFrame:
    # Most keys have one row or two in a batch, so a call for each would cost most of the time.
    watched = flat_map_groups(
        partial, ["user_id", "event_type"], watch, output, state, mode="update", timeout="event", merge=merge
    )
    out = new_folder(spark, "out")
    with settings(spark, state_settings(spark, **SINGLE_WATERMARK)):
        run_steps(into_table(watched, out, "update"), new_folder(spark, "checkpoint"))
    return spark.read.parquet(out)


def _slots_ms(slots: pd.Series) -> pd.Series:
    """Wall time in milliseconds."""
    return slots.dt.tz_localize(None).astype("datetime64[ms]").astype("int64")


def _slot_ms(chunk: pd.DataFrame) -> int:
    return int(_slots_ms(chunk["slot"]).max())


@query(
    TIMELY_SQL
    + f""",
    seen as (
        select *, max(high) over (w) as last, lead(b) over (partition by user_id, event_type order by b) as next_b
        from timely window w as (partition by user_id, event_type order by b)),
    -- a key is closed in the batches between two with rows of it, if the mark passes its time there
    ends as (
        select s.*, coalesce(s.last + {GAP_MS} < e.next_mark and (next_b is null or next_b > s.b + 1), false) as closes
        from seen s left join marks e on e.b = coalesce(s.next_b - 2, e.final)),
    runs as (
        select *, coalesce(sum(closes::int) over (partition by user_id, event_type order by b
                           rows between unbounded preceding and 1 preceding), 0) as run
        from ends),
    counted as (
        select *, (sum(k) over (partition by user_id, event_type, run order by b))::bigint as n from runs)
    select user_id, event_type, n, false as closed from counted
    union all
    select user_id, event_type, n, true from counted where closes
    """
)
def timeout_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that stay quiet for six hours of event time are closed, over many batches.

    Late rows are dropped; a key that returns in time, or in the batch in which its time would be
    up, goes on; one that returns later starts anew.
    """

    def watch(keys, rows, states):
        if states.hasTimedOut:
            yield keys.assign(n=states.get["n"], closed=True)
            states.remove()
            return
        n = states.get["n"].fillna(0) + rows["n"]
        last = np.maximum(states.get["last_ms"].fillna(0).astype("int64"), _slots_ms(rows["slot"]))
        states.update({"n": n, "last_ms": last})
        states.setTimeoutTimestamp(last + GAP_MS)
        yield keys.assign(n=n, closed=False)

    output = "user_id long, event_type string, n long, closed boolean"
    merge = {"n": "sum", "slot": "max"}
    rows = _run(spark, _partials(spark, sf_dir), watch, output, "n long, last_ms long", merge)
    return rows.select("user_id", "event_type", "n", "closed")


@query(
    TIMELY_SQL
    + f""",
    seen as (
        select *, case when last_digit = 0 then 'removed' when last_digit = 1 then 'touched' else 'updated' end as change,
               lead(b) over (partition by user_id, event_type order by b) as next_b
        from timely),
    ends as (
        select s.*, coalesce(s.high + {GAP_MS} < e.next_mark and (next_b is null or next_b > s.b + 1), false) as closes
        from seen s left join marks e on e.b = coalesce(s.next_b - 2, e.final)),
    runs as (
        select *, sum((change = 'removed')::int) over (partition by user_id, event_type order by b)
               + coalesce(sum(closes::int) over (partition by user_id, event_type order by b
                          rows between unbounded preceding and 1 preceding), 0) as run
        from ends),
    counted as (
        select *, (sum(case when change = 'updated' then k end)
                   over (partition by user_id, event_type, run order by b))::bigint as n
        from runs)
    select user_id, event_type, change, n from counted
    union all
    select user_id, event_type, 'timed out', n from counted where closes
    """
)
def state_lifecycle_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a batch does to a key's state, under timeouts: all branches, over many batches.

    By the last event of a key in a batch its state is removed while a timeout is set, or only the timeout is
    changed, or state and timeout are updated.  A key whose time is up is called once, with or without
    state, and is then removed for good.
    """

    def keep(keys, rows, states):
        if states.hasTimedOut:
            yield keys.assign(change="timed out", n=states.get["n"])
            states.remove()
            return
        digit = rows["last_id"].astype("int64").clip(lower=-1) % 5
        removed, touched = digit == 0, digit == 1
        states.remove(removed)
        states.update({"n": states.get["n"].fillna(0) + rows["n"]}, ~(removed | touched))
        states.setTimeoutTimestamp(_slots_ms(rows["slot"]).clip(lower=0) + GAP_MS)
        change = np.select([removed, touched], ["removed", "touched"], "updated")
        yield keys.assign(change=change, n=states.get["n"])

    output = "user_id long, event_type string, change string, n long"
    merge = {"n": "sum", "last_id": "max", "slot": "max"}
    rows = _run(spark, _partials(spark, sf_dir), keep, output, "n long", merge)
    return rows.select("user_id", "event_type", "change", "n")
