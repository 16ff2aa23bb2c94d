"""Queries over the keyed cache."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder
from ..streaming.cache import KeyedCache, cache_answers, cache_batches, cache_state
from ..streaming.running import run_available, run_steps
from .inputs import DECADE_SQL, events_stream, log_stream, parsed
from .registry import query

# Commands made of events: a view asks for the user's value, an error removes
# it, everything else puts the event's own number.
OP_SQL = "case event_type when 'view' then 'get' when 'error' then 'remove' else 'put' end"


def _op() -> Column:
    return (
        F.when(F.col("event_type") == "view", "get")
        .when(F.col("event_type") == "error", "remove")
        .otherwise("put")
    )


def _cache(root: str, **options) -> KeyedCache:
    settings = {
        "key": F.col("user_id"),
        "op": _op(),
        "value": F.col("event_id"),
        "seq": F.col("event_id"),
    }
    return KeyedCache(root, **{**settings, **options})


def _run(spark: SparkSession, sf_dir: str, **options) -> str:
    """Ten days of commands per batch; the path of the cache afterwards."""
    root = new_folder(spark, "cache")
    commands = parsed(log_stream(spark, sf_dir, "decades"))
    cache = _cache(root, full_every=2, **options)
    run_steps(cache.stream(commands), new_folder(spark, "checkpoint"))
    return root


ANSWERS_SQL = f"""
    with commands as (select user_id as key, event_id as seq, {OP_SQL} as op from events),
    seen as (
        select *, last_value(case when op <> 'get' then seq end ignore nulls) over w as last_change,
               last_value(case when op <> 'get' then op end ignore nulls) over w as last_op
        from commands
        window w as (partition by key order by seq
                     rows between unbounded preceding and 1 preceding))
    select key, seq, case when last_op = 'put' then last_change end as value
    from seen where op = 'get'
"""

STATE_SQL = f"""
    with changes as (
        select user_id as key, event_id as seq, {OP_SQL} as op
        from events where event_type <> 'view'),
    last as (select key, max(seq) as seq, arg_max(op, seq) as op from changes group by key)
    select key, seq as value from last where op = 'put'
"""


@query(ANSWERS_SQL)
def cache_get_after_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers to all gets, with values carried over three batches."""
    root = _run(spark, sf_dir)
    return cache_answers(spark, root).select("key", "seq", "value")


@query(ANSWERS_SQL)
def cache_single_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with all commands in one batch: the answers do not change."""
    root = new_folder(spark, "cache")
    run_available(
        _cache(root).stream(events_stream(spark, sf_dir)), new_folder(spark, "checkpoint")
    )
    return cache_answers(spark, root).select("key", "seq", "value")


@query(
    f"""
    with changes as (
        select user_id as key, event_id as seq, {OP_SQL} as op
        from events where event_type <> 'view'),
    last as (
        select key, max(seq) filter (op = 'put') as put, max(seq) filter (op = 'remove') as removed
        from changes group by key)
    select key, coalesce(put, -1) > coalesce(removed, -1) as present from last
    """
)
def cache_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the users with a put or a removal are in the cache at the end."""
    root = _run(spark, sf_dir)
    touched = spark.read.parquet(f"{root}/changes").select("key").distinct()
    present = cache_state(spark, root).select("key", F.lit(True).alias("present"))
    return touched.join(present, "key", "left").select(
        "key", F.coalesce("present", F.lit(False)).alias("present")
    )


@query(STATE_SQL)
def cache_final_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache after the last commit."""
    return cache_state(spark, _run(spark, sf_dir)).select("key", "value")


@query(
    f"""
    with steps as (
        select *, user_id as key, {DECADE_SQL} as step from events),
    aborted as (
        select distinct key, step from steps
        where event_type = 'signup' and day(ts) > 10 and user_id % 3 = 0),
    changes as (
        select s.key, event_id as seq,
               case when event_type = 'error' then 'remove' else 'put' end as op
        from steps s anti join aborted a on s.key = a.key and s.step = a.step
        where event_type <> 'view'),
    last as (select key, max(seq) as seq, arg_max(op, seq) as op from changes group by key)
    select key, seq as value from last where op = 'put'
    """
)
def cache_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the eleventh day on, a signup of every third user aborts that user's batch: its
    changes are dropped, the values of earlier batches stay."""
    aborts = (F.col("event_type") == "signup") & (F.dayofmonth("ts") > 10) & (F.col("user_id") % 3 == 0)
    op = F.when(aborts, "abort").otherwise(_op())
    return cache_state(spark, _run(spark, sf_dir, op=op)).select("key", "value")


@query(
    """
    with changes as (
        select case when event_type in ('click', 'purchase') then 'shop' else 'site' end as cache,
               user_id as key, event_id as seq,
               case when event_type in ('error', 'purchase') then 'remove' else 'put' end as op
        from events),
    last as (
        select cache, key, max(seq) as seq, arg_max(op, seq) as op from changes group by all)
    select cache, key, seq as value from last where op = 'put'
    """
)
def cache_two_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two caches in one stream; the same key in both."""
    kind = F.col("event_type")
    name = F.when(kind.isin("click", "purchase"), "shop").otherwise("site")
    op = F.when(kind.isin("error", "purchase"), "remove").otherwise("put")
    root = _run(spark, sf_dir, cache=name, op=op)
    return cache_state(spark, root).select("cache", "key", "value")


TTL_SQL = f"""
    with commands as (
        select user_id as key, event_id as seq, ts, {OP_SQL} as op from events),
    seen as (
        select *, last_value(case when op <> 'get' then seq end ignore nulls) over w as last_change,
               last_value(case when op <> 'get' then op end ignore nulls) over w as last_op,
               last_value(case when op <> 'get' then ts end ignore nulls) over w as last_ts
        from commands
        window w as (partition by key order by seq
                     rows between unbounded preceding and 1 preceding))
    select key, seq,
           case when last_op = 'put' and last_ts + interval '6' hour > ts
                then last_change end as value
    from seen where op = 'get'
"""


@query(TTL_SQL)
def cache_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that live for six hours of event time."""
    root = _run(spark, sf_dir, at=F.col("ts"), ttl="6:00:00")
    return cache_answers(spark, root).select("key", "seq", "value")


ENTRY_TTL_SQL = "case when user_id % 5 > 0 then (event_id % 4 + 1) * 10800 end"


@query(
    f"""
    with commands as (
        select user_id as key, event_id as seq, ts, {OP_SQL} as op, {ENTRY_TTL_SQL} as ttl from events),
    seen as (
        select *, last_value(case when op <> 'get' then seq end ignore nulls) over w as last_change,
               last_value(case when op <> 'get' then op end ignore nulls) over w as last_op,
               last_value(case when op <> 'get' then coalesce(epoch_ms(ts) + ttl * 1000, 1e15::bigint) end ignore nulls)
                   over w as ends_ms
        from commands
        window w as (partition by key order by seq
                     rows between unbounded preceding and 1 preceding)),
    last as (
        select key, max(seq) as seq, arg_max(op, seq) as op,
               arg_max(coalesce(epoch_ms(ts) + ttl * 1000, 1e15::bigint), seq) as ends_ms
        from commands where op <> 'get' group by key)
    select 'answer' as kind, key, seq, case when last_op = 'put' and ends_ms > epoch_ms(ts) then last_change end as value
    from seen where op = 'get'
    union all
    select 'left', key, seq, seq from last
    where op = 'put' and ends_ms > (select max(epoch_ms(ts)) from commands)
    """
)
def cache_entry_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value has its own time to live, or none: what gets see, and what is left at the end."""
    ttl = F.when(F.col("user_id") % 5 > 0, (F.col("event_id") % 4 + 1) * 10800)
    root = _run(spark, sf_dir, at=F.date_trunc("millisecond", "ts"), ttl=ttl)
    left = cache_state(spark, root).select(F.lit("left").alias("kind"), "key", "seq", "value")
    return cache_answers(spark, root).select(F.lit("answer").alias("kind"), "key", "seq", "value").unionByName(left)


@query(
    f"""
    with changes as (
        select user_id as key, event_id as seq, {OP_SQL} as op, {DECADE_SQL} as step
        from events where event_type <> 'view'),
    steps as (select distinct {DECADE_SQL} as step from events),
    versions as (select step, row_number() over (order by step) - 1 as version from steps),
    last as (
        select v.version, c.key, max(c.seq) as seq, arg_max(c.op, c.seq) as op
        from versions v join changes c on c.step <= v.step group by all)
    select version, key, seq as value from last where op = 'put'
    """
)
def cache_every_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache as it was after each of the batches."""
    root = _run(spark, sf_dir)
    versions = [
        cache_state(spark, root, version).select(
            F.lit(version).cast("long").alias("version"), "key", "value"
        )
        for version in cache_batches(spark, root)
    ]
    return reduce(DataFrame.unionByName, versions)
