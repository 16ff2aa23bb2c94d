"""Inputs of the named queries: the given tables, and logs derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import Files, new_folder
from ..sources import register, write_manifest

EVENTS_SCHEMA = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
)

_logs: dict[tuple[str, str, str], str] = {}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream, all of it in one micro-batch."""
    path = f"{sf_dir}/events.parquet"
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if Files(spark, path).is_file(path):
        # A file stream watches folders; pick the one file out of its folder.
        return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return reader.parquet(path)


def event_day() -> Column:
    return F.to_date("ts")


def event_line() -> Column:
    """event_id|user_id|event_type|time in microseconds."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return F.concat_ws("|", "event_id", "user_id", F.coalesce("event_type", F.lit("")), micros)


# The line in SQL, for the oracles.
LINE_SQL = (
    "event_id || '|' || user_id || '|' || coalesce(event_type, '') || '|' || epoch_us(ts)"
)


def parsed(lines: DataFrame) -> DataFrame:
    """Log rows back to event columns."""
    part = F.split("value", r"\|")
    return lines.select(
        "cti",
        part[0].cast("long").alias("event_id"),
        part[1].cast("long").alias("user_id"),
        part[2].alias("event_type"),
        F.timestamp_micros(part[3].cast("long")).alias("ts"),
    )


def arrival_day() -> Column:
    """Every seventh event arrives two days late; all of them do arrive."""
    late = F.col("event_id") % 7 == 0
    return F.when(late, F.date_add(event_day(), 2)).otherwise(event_day())


ARRIVAL_DAY_SQL = "case when event_id % 7 = 0 then ts::date + 2 else ts::date end"


def arrival_block(days: int = 5) -> Column:
    """Events arrive in blocks of so many days, every seventh one block late."""
    block = F.date_sub(event_day(), F.pmod(F.unix_date(event_day()), F.lit(days)))
    late = F.col("event_id") % 7 == 0
    return F.when(late, F.date_add(block, days)).otherwise(block)


def arrival_block_sql(days: int = 5) -> str:
    return (
        f"(ts::date - ((ts::date - date '1970-01-01') % {days})::int"
        f" + case when event_id % 7 = 0 then {days} else 0 end)::date"
    )


ARRIVAL_BLOCK_SQL = arrival_block_sql()


def first_days_of_decades() -> Column:
    """Three parts of the month: days 1-10, 11-20 and the rest."""
    day = F.dayofmonth("ts")
    part = F.least(F.floor((day - 1) / 10), F.lit(2)).cast("int")
    return F.date_add(F.trunc(event_day(), "month"), part * 10)


DECADE_SQL = (
    "(date_trunc('month', ts)::date + least((day(ts) - 1) // 10, 2)::int * 10)::date"
)


def log_folder(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Derive a log of text lines from ``events``, once per session and kind.

    ``days``: one step per day, the first a snapshot, the last not ready;
    ``ready_days``: one step per day, all ready, none a snapshot;
    ``arrivals``: one step per block of arrival, all ready;
    ``short_arrivals``: the same with blocks of three days;
    ``decades``: one step per ten days, all ready;
    ``packed``: the same with compressed files;
    ``closing``: like ``decades``, plus a last step that is not ready.
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _logs:
        _logs[key] = _write_log(spark, sf_dir, kind)
    return _logs[key]


def _write_log(spark: SparkSession, sf_dir: str, kind: str) -> str:
    root = new_folder(spark, f"log-{kind}")
    step = {
        "days": event_day,
        "ready_days": event_day,
        "arrivals": arrival_block,
        "short_arrivals": lambda: arrival_block(3),
        "decades": first_days_of_decades,
        "packed": first_days_of_decades,
        "closing": first_days_of_decades,
    }[kind]()
    lines = events(spark, sf_dir).select(
        step.alias("step"),
        (F.col("event_id") % 3).alias("part"),
        event_line().alias("line"),
    )
    # The rebalance hint splits a large step over several files and puts small
    # ones together, so neither a hot day nor a thousand tiny files results.
    codec = "gzip" if kind == "packed" else "none"
    dealt = lines.hint("rebalance", "step", "part").write.partitionBy("step", "part")
    dealt.option("compression", codec).text(f"{root}/lines")

    # One row per step from here on.
    days = events(spark, sf_dir).select(step.alias("step")).distinct()
    if kind == "closing":
        last = days.agg(F.date_add(F.max("step"), 10).alias("step"))
        days = days.unionByName(last)
    order = Window.orderBy("step")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, last = F.min("step").over(whole), F.max("step").over(whole)
    gated = kind in ("days", "closing")
    manifest = days.select(
        (F.row_number().over(order) - 1).cast("long").alias("offset"),
        F.lit("events").alias("name"),
        F.col("step").cast("timestamp").alias("cti"),
        F.lit(3).alias("partitions"),
        (F.col("step") == first if kind == "days" else F.lit(False)).alias("is_snapshot"),
        (F.col("step") < last if gated else F.lit(True)).alias("is_ready"),
        F.concat(F.lit(f"{root}/lines/step="), F.col("step").cast("string")).alias("path"),
    )
    write_manifest(manifest, f"{root}/manifest")
    return root


def log_stream(spark: SparkSession, sf_dir: str, kind: str, **options: str) -> DataFrame:
    """The log as a stream that advances one step per trigger."""
    register(spark)
    root = log_folder(spark, sf_dir, kind)
    options.setdefault("historyPath", new_folder(spark, "history"))
    return (
        spark.readStream.format("batchlog")
        .option("reader", "manifest")
        .option("manifestPath", f"{root}/manifest")
        .options(**options)
        .load()
    )


def tables_log(spark: SparkSession, sf_dir: str) -> str:
    """A log of two tables that advance at different steps.

    At step k the set holds the k-th ten days of ``events`` and the (k/2)-th year of ``orders``, or
    their last ones: entries stay in the set for several steps.  The last year isn't ready.
    """
    root = new_folder(spark, "log-tables")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderdate is not null")
    year = F.trunc(F.col("o_orderdate").cast("date"), "year")
    lines = {
        "events": events(spark, sf_dir).where("ts is not null").select(first_days_of_decades().alias("step"), event_line().alias("line")),
        "orders": orders.select(year.alias("step"), F.concat_ws("|", "o_orderkey", "o_custkey").alias("line")),
    }
    entries = []
    for name, rows in lines.items():
        rows.hint("rebalance", "step").write.partitionBy("step").text(f"{root}/{name}")
        # One row per step from here on.
        steps = rows.select("step").distinct()
        place = F.row_number().over(Window.orderBy("step")) - 1
        entries.append(steps.select(F.lit(name).alias("name"), "step", place.alias("place")))
    ranked = entries[0].unionByName(entries[1])
    pace = F.when(F.col("name") == "events", 1).otherwise(2)
    counted = ranked.withColumn("pace", pace).withColumn("last", F.max("place").over(Window.partitionBy("name")))
    end = F.max(F.col("place") * F.col("pace")).over(Window.partitionBy())
    tables = counted.withColumn("end", end).select("name", "last", "pace", "end").distinct()
    sets = tables.withColumn("offset", F.explode(F.sequence(F.lit(0), "end")))
    here = F.least(F.floor(F.col("offset") / F.col("pace")), F.col("last")).cast("int")
    manifest = sets.withColumn("place", here).join(counted.select("name", "place", "step"), ["name", "place"])
    manifest = manifest.select(
        F.col("offset").cast("long"),
        "name",
        F.col("step").cast("timestamp").alias("cti"),
        F.lit(2).alias("partitions"),
        F.lit(False).alias("is_snapshot"),
        ((F.col("name") == "events") | (F.col("place") < F.col("last"))).alias("is_ready"),
        F.concat(F.lit(f"{root}/"), "name", F.lit("/step="), F.col("step").cast("string")).alias("path"),
    )
    write_manifest(manifest, f"{root}/manifest")
    return root
