"""A keyed cache that a stream of commands works on.

A command is a row with an operation (``put``, ``get``, ``remove``, ``abort``), a
key, a value, and a sequence number that orders the commands of a batch.  The
batch number is the version of the cache: what batch N puts and removes becomes
visible to later batches as one change set when the batch ends, and to later
``get`` commands of the same batch at once.

Keys are dealt to buckets by hash.  Layout under the cache's root::

    changes/batch_id=N/bucket=B/   last put or removal per key in batch N
    base/batch_id=N/bucket=B/      the values in bucket B after batch N
    full/batch_id=N/               which bases make up the whole cache after batch N
    notes/batch_id=N.json          the buckets that batch N changed, and the time it reached
    answers/batch_id=N/            one row per get

A batch reads the buckets it asks for.  Now and then the buckets that were changed since their
base get a new one, and those in which a value's time is up; the others keep theirs.  So a batch costs what it
touches, and removed and expired values are gone from the bases.

A batch reads versions below its own only and replaces its folders as a whole,
so a repeated batch gives the same result.  Versions older than ``keep`` batches
are deleted; the answers are output and stay.

No task handles all commands of a key: the commands are range partitioned by
key *and* sequence number, so a busy key is cut into slices, and what a slice
needs to know of the earlier ones is one value per slice.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import Future
from threading import Thread

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from ..functions.scalars import duration_seconds
from ..session import Files, settings

OPERATIONS = ("put", "get", "remove", "abort")


class KeyedCache:
    """Settings of a cache.

    ``cache`` names the cache a command is meant for, so that one stream can
    serve several.  With ``ttl`` a value is gone that long after the time
    ``at`` of its put; by default values stay.  A column as ``ttl`` gives each put its own number of
    seconds, null for values that stay.  Time is what commands tell: a get sees what is alive at its own
    ``at``, and a value whose time was up by the largest ``at`` of an earlier batch is gone.

    ``buckets`` is fixed by the first batch of a cache, by default as the number of shuffle partitions; a
    bucket's values should fit a file.
    """

    def __init__(
        self,
        root: str,
        key: Column,
        op: Column,
        value: Column,
        seq: Column,
        cache: Column | None = None,
        at: Column | None = None,
        ttl: str | Column | None = None,
        full_every: int = 10,
        keep: int = 100,
        buckets: int | None = None,
    ):
        if (ttl is None) != (at is None):
            raise ValueError("ttl and at belong together")
        if full_every < 1:
            raise ValueError("full_every must be positive")
        if keep < 1:
            raise ValueError("keep must be positive")
        if buckets is not None and buckets < 1:
            raise ValueError("buckets must be positive")
        self.root = root.rstrip("/")
        self._columns = [
            (F.lit("default") if cache is None else cache).alias("cache"),
            key.alias("key"),
            op.alias("op"),
            value.alias("value"),
            seq.alias("seq"),
            (F.lit(None) if at is None else at).cast("timestamp").alias("at"),
        ]
        seconds = F.lit(duration_seconds(ttl)) if isinstance(ttl, str) else F.lit(None) if ttl is None else ttl
        self._columns.append(seconds.cast("long").alias("ttl"))
        self._full_every = full_every
        self._keep = keep
        self._buckets = buckets

    def stream(self, commands: DataFrame) -> DataStreamWriter:
        return commands.writeStream.foreachBatch(self.write_batch)

    def write_batch(self, commands: DataFrame, batch_id: int) -> None:
        spark = commands.sparkSession
        files = Files(spark, self.root)
        files.delete(f"{self.root}/full/batch_id={batch_id}")  # of an attempt that is repeated
        self._settle(spark, files)
        staged = self._staged(commands, batch_id)
        schema = _change_schema(staged)
        if not files.exists(f"{self.root}/schema.json"):
            files.put(f"{self.root}/schema.json", schema.json())
        changes = self._changes(staged).repartition("bucket")
        writing = _start(
            spark, lambda: changes.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/changes/batch_id={batch_id}")
        )
        # One row per bucket: where commands ask, and where they change something.
        met = staged.groupBy("bucket").agg(
            F.max(F.col("op") == "get").alias("asks"),
            F.max(F.col("op").isin("put", "remove")).alias("changes"),
            F.max(F.unix_millis("at")).alias("at"),
        ).collect()
        clock = _clock(files, self.root, batch_id - 1)
        asked = [r["bucket"] for r in met if r["asks"]]
        before = _alive(cache_versions(spark, self.root, batch_id - 1, schema, asked), clock)
        answers = self._answers(staged, before)
        answers.write.mode("overwrite").parquet(f"{self.root}/answers/batch_id={batch_id}")
        writing.result()
        reached = max((r["at"] for r in met if r["at"] is not None), default=None)
        note = {
            "buckets": sorted(r["bucket"] for r in met if r["changes"]),
            "clock": max((t for t in (clock, reached) if t is not None), default=None),
        }
        files.put(f"{self.root}/notes/batch_id={batch_id}.json", json.dumps(note))
        if (batch_id + 1) % self._full_every == 0:
            # Bounds how many change sets a later batch has to read.
            self._compact(spark, files, batch_id, schema, note["clock"])
            self._forget(files, batch_id - self._keep)
        files.delete(f"{self.root}/staged/batch_id={batch_id}")

    def _settle(self, spark: SparkSession, files: Files) -> None:
        """The number of buckets, as the cache's first batch had it."""
        path = f"{self.root}/buckets.json"
        if not files.exists(path):
            files.put(path, json.dumps(self._buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))))
        stored = json.loads(files.text(path))
        if self._buckets not in (None, stored):
            raise ValueError(f"the cache has {stored} buckets, not {self._buckets}")
        self._buckets = stored

    def _compact(self, spark: SparkSession, files: Files, batch_id: int, schema: StructType, clock: int | None) -> None:
        """New bases for the buckets changed since their last one, or with values whose time is up."""
        last, bases = _bases(files, self.root, batch_id - 1)
        stale = {b for n in _batches(files, f"{self.root}/changes") if last < n <= batch_id for b in _note(files, self.root, n)["buckets"]}
        if clock is not None:
            stale |= {b for b, (_, first) in bases.items() if first is not None and first <= clock}
        target = f"{self.root}/base/batch_id={batch_id}"
        if stale:
            values = _alive(cache_versions(spark, self.root, batch_id, schema, sorted(stale)), clock).filter("op = 'put'")
            values.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
            written = [int(name.removeprefix("bucket=")) for name in files.names(target) if name.startswith("bucket=")]
            bases = {b: base for b, base in bases.items() if b not in stale}
            if written:
                # One row per bucket: the first time at which a value of it is gone.
                dealt = StructType([*schema.fields, StructField("bucket", IntegerType())])
                firsts = spark.read.schema(dealt).parquet(target).groupBy("bucket")
                rows = firsts.agg(F.min(F.unix_millis("expires_at")).alias("first")).collect()
                bases |= {r["bucket"]: (batch_id, r["first"]) for r in rows}
        files.put(f"{self.root}/full/batch_id={batch_id}/bases.json", json.dumps({str(b): base for b, base in bases.items()}))

    def _forget(self, files: Files, oldest: int) -> None:
        """Delete what no version from ``oldest`` on needs."""
        fulls = _batches(files, f"{self.root}/full")
        base = max((n for n in fulls if n <= oldest), default=-1)
        for n in _batches(files, f"{self.root}/changes"):
            if n <= base:
                files.delete(f"{self.root}/changes/batch_id={n}")
                if n < base:  # the time that the oldest kept version had reached is still asked for
                    files.delete(f"{self.root}/notes/batch_id={n}.json")
        for n in fulls:
            if n < base:
                files.delete(f"{self.root}/full/batch_id={n}")
        used = {n for m in fulls if m >= base for n, _ in _bases(files, self.root, m)[1].values()}
        for n in _batches(files, f"{self.root}/base"):
            if n < base and n not in used:
                files.delete(f"{self.root}/base/batch_id={n}")

    def _bucket(self) -> Column:
        if self._buckets is None:
            raise ValueError("the number of buckets isn't settled before the first batch")
        return F.pmod(F.xxhash64("cache", "key"), F.lit(self._buckets)).cast("int")

    def _staged(self, commands: DataFrame, batch_id: int) -> DataFrame:
        """The commands in slices of the order (cache, key, seq), as a table.

        Written out so that every later step sees the same slices.
        """
        path = f"{self.root}/staged/batch_id={batch_id}"
        known = F.col("op").isin(*OPERATIONS)
        problem = F.raise_error(F.concat(F.lit("unknown cache operation: "), "op"))
        expires = F.col("at") + F.make_dt_interval(secs=F.col("ttl").cast("decimal(18,6)"))
        staged = (
            commands.select(*self._columns)
            .withColumn("op", F.when(known, F.col("op")).otherwise(problem))
            .withColumn("expires_at", expires)
            .drop("ttl")
            .withColumn("bucket", self._bucket())
            .repartitionByRange("cache", "key", "seq")
            .withColumn("slice", F.spark_partition_id())
        )
        staged.write.mode("overwrite").parquet(path)
        return commands.sparkSession.read.schema(staged.schema).parquet(path)

    def _changes(self, staged: DataFrame) -> DataFrame:
        """Last put or removal per key; none for keys with an abort."""
        change = F.struct("op", "value", "seq", "expires_at")
        is_change = F.col("op").isin("put", "remove")
        return (
            staged.filter(F.col("op") != "get")
            .groupBy("bucket", "cache", "key")
            .agg(
                F.max_by(F.when(is_change, change), F.when(is_change, F.col("seq"))).alias("last"),
                F.max(F.col("op") == "abort").alias("aborted"),
            )
            .filter("not aborted and last is not null")
            .select("bucket", "cache", "key", "last.*")
        )

    def _answers(self, staged: DataFrame, before: DataFrame) -> DataFrame:
        """For each get the latest put or removal ahead of it."""
        is_change = F.col("op").isin("put", "remove")
        change = F.when(is_change, F.struct("op", "value", "expires_at"))
        keys = ["cache", "key"]

        # One row per key and slice: its last change and whether it has gets.
        slices = staged.groupBy(*keys, "slice").agg(
            F.max_by(change, F.when(is_change, F.col("seq"))).alias("last"),
            F.max(F.col("op") == "get").alias("asks"),
        )
        earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(
            Window.unboundedPreceding, -1
        )
        carried = slices.withColumn("carried", F.last("last", ignorenulls=True).over(earlier))
        # Keys may be null, so the joins compare them null-safely.
        stored = before.select(
            F.col("cache").alias("s_cache"),
            F.col("key").alias("s_key"),
            F.struct("op", "value", "expires_at").alias("stored"),
        )
        same = F.col("cache").eqNullSafe(F.col("s_cache")) & F.col("key").eqNullSafe(
            F.col("s_key")
        )
        known = (
            carried.filter("asks")
            .join(stored, same, "left")
            .select(
                F.col("cache").alias("k_cache"),
                F.col("key").alias("k_key"),
                F.col("slice").alias("k_slice"),
                F.coalesce("carried", "stored").alias("known"),
            )
        )
        same_slice = (
            F.col("cache").eqNullSafe(F.col("k_cache"))
            & F.col("key").eqNullSafe(F.col("k_key"))
            & (F.col("slice") == F.col("k_slice"))
        )

        ahead = Window.partitionBy(*keys, "slice").orderBy("seq").rowsBetween(
            Window.unboundedPreceding, -1
        )
        found = F.coalesce(F.col("own"), F.col("known"))
        alive = found["expires_at"].isNull() | (found["expires_at"] > F.col("at"))
        return (
            staged.withColumn("own", F.last(change, ignorenulls=True).over(ahead))
            .filter(F.col("op") == "get")
            .join(known, same_slice, "left")
            .select(
                *keys,
                "seq",
                F.when((found["op"] == "put") & alive, found["value"]).alias("value"),
            )
        )


def cache_versions(
    spark: SparkSession, root: str, version: int, schema: StructType, buckets: list[int] | None = None
) -> DataFrame:
    """Last change per key up to a version, removals included; of some ``buckets`` only, if given."""
    files = Files(spark, root)
    last, bases = _bases(files, root, version)
    paths = [f"{root}/base/batch_id={n}/bucket={b}" for b, (n, _) in bases.items() if buckets is None or b in buckets]
    for n in _batches(files, f"{root}/changes"):
        if last < n <= version:
            # Only what is there: a noted bucket may have had nothing but aborted changes.
            there = [name for name in files.names(f"{root}/changes/batch_id={n}") if name.startswith("bucket=")]
            if buckets is not None:
                there = [name for name in there if int(name.removeprefix("bucket=")) in buckets]
            paths += [f"{root}/changes/batch_id={n}/{name}" for name in there]
    if not paths:
        return spark.createDataFrame([], schema)
    columns = ["op", "value", "seq", "expires_at", "version"]
    with settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.threshold": str(10_000)}):
        stored = spark.read.schema(schema).parquet(*paths)
    rows = stored.withColumn(
        "version",
        F.coalesce("version", F.regexp_extract("_metadata.file_path", r"/batch_id=(\d+)/bucket=\d+/[^/]*$", 1).cast("long")),
    )
    return (
        rows.groupBy("cache", "key")
        .agg(F.max_by(F.struct(*columns), "version").alias("last"))
        .select("cache", "key", "last.*")
    )


def _start(spark: SparkSession, write: Callable[[], None]) -> Future:
    """Run a write beside what follows; ``result()`` waits for it and raises its error."""
    done: Future = Future()

    def run() -> None:
        try:
            done.set_result(write())
        except BaseException as error:
            done.set_exception(error)

    Thread(target=inheritable_thread_target(spark)(run), daemon=True).start()
    return done


def _alive(rows: DataFrame, clock: int | None) -> DataFrame:
    """``rows`` without values whose time was up at ``clock`` (milliseconds)."""
    if clock is None:
        return rows
    return rows.filter(F.col("expires_at").isNull() | (F.unix_millis("expires_at") > clock))


def _batches(files: Files, folder: str) -> list[int]:
    """Numbers of the finished batch folders."""
    return [
        int(name.removeprefix("batch_id="))
        for name in files.names(folder)
        if name.startswith("batch_id=")
        and (files.exists(f"{folder}/{name}/_SUCCESS") or files.exists(f"{folder}/{name}/bases.json"))
    ]


def _bases(files: Files, root: str, version: int) -> tuple[int, dict[int, tuple[int, int | None]]]:
    """The last full version up to ``version`` (-1: none), and its buckets: batch of the base, first expiry."""
    last = max((n for n in _batches(files, f"{root}/full") if n <= version), default=-1)
    if last < 0:
        return last, {}
    found = json.loads(files.text(f"{root}/full/batch_id={last}/bases.json"))
    return last, {int(b): tuple(base) for b, base in found.items()}


def _note(files: Files, root: str, batch_id: int) -> dict:
    return json.loads(files.text(f"{root}/notes/batch_id={batch_id}.json"))


def _clock(files: Files, root: str, version: int) -> int | None:
    """The largest time that commands up to a version had."""
    if version < 0 or not files.exists(f"{root}/notes/batch_id={version}.json"):
        return None
    return _note(files, root, version)["clock"]


def _change_schema(rows: DataFrame) -> StructType:
    typed = rows.select("cache", "key", "op", "value", "seq", "expires_at")
    return typed.withColumn("version", F.lit(None).cast("long")).schema


def cache_batches(spark: SparkSession, root: str) -> list[int]:
    """The versions that ``cache_state`` can give: batches not yet cleaned up."""
    files = Files(spark, root)
    full = min(_batches(files, f"{root}/full"), default=None)
    batches = sorted(_batches(files, f"{root}/changes"))
    if full is None or not batches or batches[0] == 0:
        return batches
    return [n for n in batches if n >= full]


def cache_state(
    spark: SparkSession, root: str, version: int | None = None, now: Column | None = None
) -> DataFrame:
    """The cache as rows ``(cache, key, value, seq)``, after a batch or now.

    A version that was cleaned up already is an error.  Values whose time was up by the largest
    time of that batch's commands, or earlier ones', are gone; ``now`` leaves out those that have expired by
    that time as well.
    """
    kept = cache_batches(spark, root)
    if version is None:
        version = max(kept, default=-1)
    elif version not in kept:
        raise ValueError(f"version {version} of the cache isn't kept; there are {kept[:1]} to {kept[-1:]}")
    files = Files(spark, root)
    schema = StructType.fromJson(json.loads(files.text(f"{root}/schema.json")))
    rows = cache_versions(spark, root, version, schema).filter(F.col("op") == "put")
    rows = _alive(rows, _clock(files, root, version))
    if now is not None:
        rows = rows.filter(F.col("expires_at").isNull() | (F.col("expires_at") > now))
    return rows.select("cache", "key", "value", "seq")


def cache_answers(spark: SparkSession, root: str) -> DataFrame:
    """The answers to all get commands: ``(cache, key, seq, value)``."""
    return spark.read.parquet(f"{root}/answers").drop("batch_id")


def cache_changes(spark: SparkSession, root: str, first: int, last: int) -> DataFrame:
    """Puts and removals that the batches ``first`` to ``last`` brought."""
    rows = spark.read.parquet(f"{root}/changes").drop("bucket")
    return rows.filter(F.col("batch_id").between(first, last))
