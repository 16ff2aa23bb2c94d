"""Queries that read a stream's state as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import SINGLE_WATERMARK, flat_map_groups, pre_aggregate, time_slot, with_watermark
from ..operators.variables import VariableCounts, process_groups
from ..session import new_folder, settings, state_settings
from ..streaming import checkpoints, progress
from ..streaming.running import into_table, run_steps
from .group_queries import _add_counts, _user_counts
from .inputs import DECADE_SQL, log_stream, parsed
from .registry import query

RUNNING_SQL = f"""
    with steps as (
        select user_id, dense_rank() over (order by {DECADE_SQL}) - 1 as batch_id
        from events),
    counts as (select user_id, batch_id, count(*) as n from steps group by all)
"""


def _counted(spark: SparkSession, sf_dir: str) -> tuple[str, StreamingQuery]:
    """Keep counts per user over three batches; checkpoint and finished query."""
    counts = flat_map_groups(
        _user_counts(parsed(log_stream(spark, sf_dir, "decades"))),
        ["user_id"],
        _add_counts,
        "user_id long, n long",
        "n long",
        mode="update",
    )
    checkpoint = new_folder(spark, "checkpoint")
    with settings(spark, state_settings(spark, **checkpoints.ALL_REPORTS)):
        done = run_steps(into_table(counts, new_folder(spark, "out"), "update"), checkpoint)
    return checkpoint, done


def _rows(state: DataFrame) -> DataFrame:
    return state.select("key.user_id", F.col("value.groupState.n").alias("n"))


@query(
    RUNNING_SQL
    + "select user_id, sum(n)::bigint as n from counts where batch_id <= 1 group by user_id"
)
def state_at_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State as it was after the second of three batches."""
    checkpoint, _ = _counted(spark, sf_dir)
    return _rows(checkpoints.state_table(spark, checkpoint, batch=1))


@query("select user_id, count(*) as n from events group by user_id")
def state_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All state after the last batch."""
    checkpoint, _ = _counted(spark, sf_dir)
    return _rows(checkpoints.state_table(spark, checkpoint))


@query(
    """
    select user_id, count(*) as n from events where user_id between 3 and 12 group by user_id
    """
)
def state_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of a range of keys, both ends included."""
    checkpoint, _ = _counted(spark, sf_dir)
    state = checkpoints.state_table(spark, checkpoint)
    return _rows(checkpoints.state_range(state, "user_id", 3, 12))


@query(
    RUNNING_SQL
    + """,
    running as (
        select *, (sum(n) over (partition by user_id order by batch_id))::bigint as total
        from counts)
    select batch_id, 'update' as change_type, user_id, total as n
    from running where batch_id >= 1
    """
)
def state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch after the first wrote to the state."""
    checkpoint, _ = _counted(spark, sf_dir)
    changes = checkpoints.state_changes(spark, checkpoint, 1)
    return changes.select(
        "batch_id", "change_type", "key.user_id", F.col("value.groupState.n").alias("n")
    )


@query(
    RUNNING_SQL
    + """,
    firsts as (select user_id, min(batch_id) as batch_id from counts group by user_id)
    select c.batch_id, count(*) as rows_updated,
           (select count(*) from firsts f where f.batch_id <= c.batch_id) as rows_total
    from counts c group by c.batch_id
    """
)
def state_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in the state and keys written, per batch."""
    root = new_folder(spark, "reports")
    with progress.recorded(spark, root) as table:
        _, done = _counted(spark, sf_dir)
        table.wait(done)
    kept = progress.metrics(spark, root)
    return kept.select("batch_id", "rows_updated", "rows_total")


@query(
    f"""
    select 0 as operator_id, 'default' as store_name, 0 as first_batch,
           count(distinct {DECADE_SQL}) - 1 as last_batch
    from events
    """
)
def state_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stateful operator of the stream and the batches its state covers."""
    checkpoint, _ = _counted(spark, sf_dir)
    return checkpoints.state_catalog(spark, checkpoint).select(
        F.col("operatorId").cast("int").alias("operator_id"),
        F.col("stateStoreName").alias("store_name"),
        F.col("minBatchId").cast("int").alias("first_batch"),
        F.col("maxBatchId").alias("last_batch"),
    )


SLOT_S = 3600
GAP_MS = 400 * 86_400_000  # none ends in this table
VARIABLES_SQL = f"""
    with steps as (
        select user_id, coalesce(event_type, '') as item, dense_rank() over (order by {DECADE_SQL}) - 1 as batch_id,
               (epoch_ms(ts) // {SLOT_S * 1000} + 1) * {SLOT_S * 1000} as slot
        from events where ts is not null),
    early as (select * from steps where batch_id <= 1)
"""


def _with_variables(spark: SparkSession, sf_dir: str) -> str:
    """Keep a total, a map of counts and a timer per user over three batches; the checkpoint."""
    rows = parsed(log_stream(spark, sf_dir, "decades")).withColumn("slot", time_slot(F.col("ts"), SLOT_S))
    partial = pre_aggregate(rows.where("slot is not null"), ["user_id", "event_type", "slot"], {"n": ("event_id", "count")})
    counts = process_groups(
        with_watermark(partial, "slot", "48 hours"),
        ["user_id"],
        VariableCounts("event_type", "n", "slot", GAP_MS),
        "user_id long, n long, closed boolean",
        time="event",
    )
    checkpoint = new_folder(spark, "checkpoint")
    with settings(spark, state_settings(spark, **SINGLE_WATERMARK)):
        run_steps(into_table(counts, new_folder(spark, "out"), "update"), checkpoint)
    return checkpoint


@query(
    VARIABLES_SQL
    + """
    select 'total' as variable, user_id, null as item, count(*) as n from early group by all
    union all
    select 'kinds', user_id, item, count(*) from early group by all
    """
)
def state_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two variables of one processor as they were after the second of three batches."""
    checkpoint = _with_variables(spark, sf_dir)
    total = checkpoints.state_table(spark, checkpoint, batch=1, variable="total")
    kinds = checkpoints.state_table(spark, checkpoint, batch=1, variable="kinds")
    rows = [
        total.select(F.lit("total").alias("variable"), "key.user_id", F.lit(None).cast("string").alias("item"), "value.n"),
        kinds.select(F.lit("kinds").alias("variable"), "key.user_id", F.col("user_map_key.kind").alias("item"), "user_map_value.n"),
    ]
    return rows[0].unionByName(rows[1])


@query(VARIABLES_SQL + f"select user_id, (max(slot) + {GAP_MS})::bigint as expires_ms from early group by user_id")
def state_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timers that were registered after the second of three batches, one per user."""
    checkpoint = _with_variables(spark, sf_dir)
    return checkpoints.state_timers(spark, checkpoint, batch=1).select("key.user_id", "expires_ms")
