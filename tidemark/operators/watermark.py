"""Event-time watermarks: declaring, combining and auditing them.

The rule that the audit follows: a batch is judged by the watermark in force
when it starts, which is the largest event time of all earlier batches minus the
delay, in milliseconds, and never goes back; rows at or before it are late.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType
from pyspark.sql.window import Window

from ..functions import event_time_ms

POLICIES = ("min", "max")

# By default Spark lets a stateful operator accept rows back to the watermark of
# the batch before.  With this option one watermark decides about late rows and
# about timeouts alike.
SINGLE_WATERMARK = {"spark.sql.streaming.statefulOperator.allowMultiple": "false"}


def with_watermark(df: DataFrame, event_time: str, delay: str) -> DataFrame:
    """``withWatermark`` that also takes time columns without a zone (as UTC).

    The session time zone must be UTC for those.
    """
    if isinstance(df.schema[event_time].dataType, TimestampNTZType):
        df = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return df.withWatermark(event_time, delay)


def time_slot(event_time: Column, seconds: int) -> Column:
    """The end of the slot of so many seconds that a time lies in, as event time.

    Under a watermark with a delay of whole slots, rows of one slot are all late or all
    timely, whatever their own times: the watermark is the end of a slot itself.  So they may be merged
    ahead of the operator that drops the late ones, with their slot as a key, and nothing
    that is late hides behind a later row.  A null time has no slot.
    """
    size = seconds * 1000
    start = event_time_ms(event_time) - F.pmod(event_time_ms(event_time), F.lit(size))
    return F.timestamp_millis(start + size)


def policy_setting(policy: str) -> dict[str, str]:
    """Option that chooses the global watermark among several inputs."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    return {"spark.sql.streaming.multipleWatermarkPolicy": policy}


def combined(columns: list[Column], policy: str = "min") -> Column:
    """The global watermark of several inputs; one without data counts as zero."""
    policy_setting(policy)
    known = [F.greatest(F.coalesce(column, F.lit(0)), F.lit(0)) for column in columns]
    if len(known) == 1:
        return known[0]
    return reduce(F.least if policy == "min" else F.greatest, known)


def batch_watermarks(
    df: DataFrame, batch: str, event_time: str, delay_ms: int
) -> DataFrame:
    """Per batch: rows, largest event time, and the watermark in force."""
    earlier = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    per_batch = df.groupBy(batch).agg(
        F.count("*").alias("n"), F.max(event_time_ms(F.col(event_time))).alias("max_ms")
    )
    # One row per batch is left, so a window over all of them is small.
    in_force = F.max("max_ms").over(earlier) - delay_ms
    return per_batch.withColumn("watermark_ms", combined([in_force]))


def mark_late(df: DataFrame, batch: str, event_time: str, delay_ms: int) -> DataFrame:
    """The rows with the watermark in force for them and whether they are late."""
    bounds = batch_watermarks(df, batch, event_time, delay_ms).select(
        F.col(batch).alias("__batch"), "watermark_ms"
    )
    micros = F.unix_micros(F.col(event_time).cast("timestamp"))
    # Null-safe: rows without a batch come before all others and are kept.
    return (
        df.join(bounds, F.col(batch).eqNullSafe(F.col("__batch")))
        .drop("__batch")
        .withColumn("late", micros <= F.col("watermark_ms") * 1000)
    )


def watermark_audit(df: DataFrame, batch: str, event_time: str, delay_ms: int) -> DataFrame:
    """Per batch: rows, largest event time, watermark in force, late rows."""
    return (
        mark_late(df, batch, event_time, delay_ms)
        .groupBy(batch)
        .agg(
            F.count("*").alias("n"),
            F.max(event_time_ms(F.col(event_time))).alias("max_ms"),
            F.max("watermark_ms").alias("watermark_ms"),
            F.count_if("late").alias("late"),
        )
    )
