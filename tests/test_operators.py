"""Functions, grouped state, partition-local groups, hooks and watermarks."""

import os
import sys
from datetime import datetime

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.functions import (
    batch_of_flag,
    entry_from_json,
    entry_json,
    is_flag_name,
    parent_folder,
    parse_duration,
    same_name,
)
from tidemark.functions.scalars import duration_seconds
from tidemark.operators import (
    SINGLE_WATERMARK,
    combined,
    committed,
    flat_map_groups,
    fold_groups,
    map_groups,
    map_partitions,
    map_partitions_summed,
    mark_late,
    partition_local,
    pre_aggregate,
    watermark_audit,
    time_slot,
    with_watermark,
)
from tidemark.session import settings, state_settings
from tidemark.streaming.checkpoints import state_table
from tidemark.streaming.running import into_table, run_once

# The functions below run in workers, which cannot import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def column(spark, values, expression):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [row[0] for row in df.select(expression).collect()]


def test_durations(spark):
    texts = ["1.02:03:04", "2:03:04", "10.0:00:01", "x", "", "1:2", None]
    seconds = parse_duration(F.col("x")).cast("long")
    assert column(spark, texts, seconds) == [93784, 7384, 864001, None, None, None, None]
    assert [duration_seconds(t) for t in texts[:3]] == [93784, 7384, 864001]
    with pytest.raises(ValueError, match="duration"):
        duration_seconds("1d")


def test_small_functions(spark):
    names = ["3_1_start", "3_1_done", "x_1_done", "3_1_other", "3_1", "12_0_done"]
    assert column(spark, names, is_flag_name(F.col("x"))) == [True, True, False, False, False, True]
    assert column(spark, names, batch_of_flag(F.col("x"))) == [3, 3, None, 3, 3, 12]
    assert column(spark, ["/a/b/c", "a", "s3://b/c"], parent_folder(F.col("x"))) == [
        "/a/b", "", "s3://b",
    ]
    assert column(spark, ["Ab", "b"], same_name(F.col("x"), F.lit("aB"))) == [True, False]


def test_entry_round_trip(spark):
    df = spark.sql(
        "select 't' name, 5L cti_ms, 3 partitions, true is_snapshot, false is_ready, '/p' path"
    )
    back = df.select(entry_from_json(entry_json()).alias("e")).select("e.*")
    assert back.collect() == df.collect()
    bad = spark.sql("select '{bad' line").select(entry_from_json(F.col("line")))
    with pytest.raises(Exception):
        bad.collect()


def text_stream(spark, folder):
    os.makedirs(folder, exist_ok=True)
    return spark.readStream.schema("k string, id long, ts timestamp").json(folder)


def add_file(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as file:
        for k, number, time in rows:
            file.write(f'{{"k": "{k}", "id": {number}, "ts": "2024-01-01T{time}:00Z"}}\n')


def count(key, chunks, state):
    n = (state.get[0] if state.exists else 0) + sum(len(c) for c in chunks)
    state.update((n,))
    yield pd.DataFrame({"k": [key[0]], "n": [n]})


def test_modes_and_timeouts_are_checked(spark):
    df = spark.createDataFrame([("a", 1)], "k string, id long")
    with pytest.raises(ValueError, match="output mode"):
        flat_map_groups(df, ["k"], count, "k string, n long", "n long", mode="complete")
    with pytest.raises(ValueError, match="timeout"):
        flat_map_groups(df, ["k"], count, "k string, n long", "n long", timeout="never")


def test_groups_of_a_table(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "k string, id long")
    counts = flat_map_groups(df, ["k"], count, "k string, n long", "n long")
    assert sorted(map(tuple, counts.collect())) == [("a", 2), ("b", 1)]

    def twice(key, chunks, state):
        yield pd.DataFrame({"k": [key[0]] * 2, "n": [1, 2]})

    with pytest.raises(Exception, match="2 rows for key"):
        map_groups(df, ["k"], twice, "k string, n long", "n long").collect()


def test_state_goes_on_after_restart(spark, folder):
    counts = flat_map_groups(
        text_stream(spark, f"{folder}/in"), ["k"], count, "k string, n long", "n long", "update"
    )
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    with settings(spark, state_settings(spark)):
        add_file(f"{folder}/in", "0", [("a", 1, "10:00"), ("a", 2, "10:00"), ("b", 3, "10:00")])
        run_once(into_table(counts, out, "update"), checkpoint)
        add_file(f"{folder}/in", "1", [("a", 4, "10:00")])
        run_once(into_table(counts, out, "update"), checkpoint)
    rows = spark.read.parquet(out).select("batch_id", "k", "n")
    assert sorted(map(tuple, rows.collect())) == [(0, "a", 2), (0, "b", 1), (1, "a", 3)]
    state = state_table(spark, checkpoint).select("key.k", F.col("value.groupState.n"))
    assert sorted(map(tuple, state.collect())) == [("a", 3), ("b", 1)]


@pytest.mark.parametrize(
    "options, kept", [(SINGLE_WATERMARK, {1, 3, 5}), ({}, {1, 2, 3, 5, 6})]
)
def test_late_rows(spark, folder, options, kept):
    def keep(key, chunks, state):
        for chunk in chunks:
            yield chunk[["id"]]

    stream = with_watermark(text_stream(spark, f"{folder}/in"), "ts", "1 hour")
    rows = flat_map_groups(stream, ["k"], keep, "id long", "n long", timeout="event")
    steps = [
        [("a", 1, "10:00")],
        [("a", 2, "08:00"), ("a", 3, "10:30")],
        [("a", 4, "08:00"), ("a", 6, "09:30"), ("a", 5, "11:00")],
    ]
    with settings(spark, state_settings(spark, **options)):
        for i, step in enumerate(steps):
            add_file(f"{folder}/in", str(i), step)
            run_once(into_table(rows, f"{folder}/out"), f"{folder}/checkpoint")
    assert {r.id for r in spark.read.parquet(f"{folder}/out").collect()} == kept
    # The audit of the same rows as a table follows the single-watermark rule.
    flat = [(i, n, f"2024-01-01 {t}") for i, step in enumerate(steps) for _, n, t in step]
    table = spark.createDataFrame(flat, "batch int, id long, t string").withColumn(
        "ts", F.col("t").cast("timestamp")
    )
    on_time = mark_late(table, "batch", "ts", 3_600_000).filter("not late")
    assert {r.id for r in on_time.collect()} == {1, 3, 5}
    assert [r.late for r in watermark_audit(table, "batch", "ts", 3_600_000).orderBy("batch").collect()] == [0, 1, 2]


def test_watermark_errors(spark):
    df = spark.createDataFrame([(1,)], "id long").withColumn("ts", F.current_timestamp())
    for delay in ("-1 hour", "soon"):
        with pytest.raises(Exception):
            with_watermark(df, "ts", delay).collect()
    with pytest.raises(ValueError, match="policy"):
        combined([F.lit(1)], "mean")


def test_combined(spark):
    row = spark.range(1).select(
        combined([F.lit(5), F.lit(7)]).alias("low"),
        combined([F.lit(5), F.lit(7)], "max").alias("high"),
        combined([F.lit(5), F.lit(None).cast("int")]).alias("idle"),
        combined([F.lit(-5)]).alias("floor"),
    )
    assert tuple(row.first()) == (5, 7, 0, 0)


def test_partition_local(spark):
    def update(key, rows, state):
        return (state or 0) + len(rows)

    def finish(key, state):
        return [(key[0], state)]

    df = spark.range(10_000).select((F.col("id") % 7).alias("k"), "id").coalesce(1)
    local = partition_local(df, ["k"], update, finish, "k long, n long")
    text = plan(local)
    assert "Exchange" not in text and "Sort" not in text
    got = {r.k: r.n for r in local.collect()}
    assert got == {k: len(range(k, 10_000, 7)) for k in range(7)}
    # With a bound on the states the parts still add up.
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "100"}):
        bounded = partition_local(
            df, ["k"], update, finish, "k long, n long", max_groups=3, chunk_rows=150
        )
        parts = bounded.groupBy("k").agg(F.sum("n"), F.count("*")).collect()
    assert {r.k: r[1] for r in parts} == got
    assert all(r[2] > 1 for r in parts)


def test_pre_aggregate_shrinks_a_hot_key(spark):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    df = spark.range(0, 30_000, 1, 4).select(hot.alias("k"), "id")
    partial = pre_aggregate(
        df, ["k"], {"n": ("id", "count"), "s": ("id", "sum"), "low": ("id", "min"), "high": ("id", "max")}
    )
    assert "Exchange" not in plan(partial)
    assert partial.filter("k = 0").count() <= 4
    whole = partial.groupBy("k").agg(F.sum("n"), F.sum("s"), F.min("low"), F.max("high"))
    want = df.groupBy("k").agg(F.count("id"), F.sum("id"), F.min("id"), F.max("id"))
    assert whole.exceptAll(want).count() == 0 and want.exceptAll(whole).count() == 0
    narrow = df.select("k", F.lit(2_000_000_000).alias("i"), F.lit(0.5).cast("float").alias("f"))
    sums = pre_aggregate(narrow, ["k"], {"i": ("i", "sum"), "f": ("f", "sum")})
    assert sums.agg(F.sum("i"), F.sum("f")).first() == (60_000_000_000_000, 15_000.0)
    bounded = pre_aggregate(df, ["k"], {"n": ("id", "count")}, max_groups=50)
    assert bounded.agg(F.sum("n")).first()[0] == 30_000
    with pytest.raises(ValueError, match="merge"):
        pre_aggregate(df, ["k"], {"m": ("id", "mean")})


def test_map_partitions_and_hook(spark, folder):
    def passed(chunks):
        for chunk in chunks:
            yield chunk

    def failing(chunks):
        yield next(chunks)
        raise RuntimeError("stop here")

    def hook(partition, finished):
        with open(f"{folder}/{partition}-{finished}", "w"):
            pass

    df = spark.range(0, 6, 1, 3).filter("id <> 2 and id <> 3")
    assert map_partitions(df, passed, "id long", hook).count() == 4
    # The hook also ran for the partition without rows.
    assert sorted(os.listdir(folder)) == ["0-True", "1-True", "2-True"]
    with pytest.raises(Exception, match="stop here"):
        map_partitions(df.limit(2), failing, "id long", hook).collect()
    assert "0-False" in os.listdir(folder)


def test_time_slots_are_late_as_a_whole(spark):
    times = [datetime(2024, 1, 1, 5, 59, 59, 999_000), datetime(2024, 1, 1, 6), datetime(1969, 12, 31, 23, 30), None]
    frame = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    got = [r.slot for r in frame.select(F.unix_millis(time_slot(F.col("ts"), 3600)).alias("slot")).collect()]
    hour = 3_600_000
    first = 1_704_067_200_000  # 2024-01-01
    assert got == [first + 6 * hour, first + 7 * hour, 0, None]


@pytest.mark.parametrize("held", [1, 3, 100_000])
def test_fold_groups_is_the_same_for_any_bound(spark, held):
    rows = [(i % 7 if i % 5 else None, i) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, v long").repartition(5)

    def update(key, chunk, state):
        n, total = len(chunk), int(chunk["v"].sum())
        return (n, total) if state is None else (state[0] + n, state[1] + total)

    found = fold_groups(
        df,
        ["k"],
        "n long, total long",
        update,
        lambda key, a, b: (a[0] + b[0], a[1] + b[1]),
        lambda key, state: [(key[0], *state)],
        "k int, n long, total long",
        held_groups=held,
        chunk_rows=10,
    )
    want = {}
    for k, v in rows:
        n, total = want.get(k, (0, 0))
        want[k] = (n + 1, total + v)
    got = found.collect()
    assert len(got) == len(want)
    assert {r.k: (r.n, r.total) for r in got} == want


def test_fold_groups_zeros_nan_and_no_rows(spark):
    def fold(df):
        return fold_groups(
            df,
            ["x"],
            "n long",
            lambda key, chunk, state: ((state or (0,))[0] + len(chunk),),
            lambda key, a, b: (a[0] + b[0],),
            lambda key, state: [(str(key[0]), state[0])],
            "x string, n long",
        )

    values = [0.0, -0.0, float("nan"), float("nan"), None, None, 1.5]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    assert sorted((r.x.lower(), r.n) for r in fold(df).collect()) == [("0.0", 2), ("1.5", 1), ("nan", 2), ("none", 2)]
    assert fold(df.filter("false")).collect() == []


def _counted(chunks, totals):
    totals["n"] = 0
    for chunk in chunks:
        totals["n"] += len(chunk)
        yield chunk


def test_summary_of_each_partition(spark):
    df = spark.range(100, numPartitions=4).filter("id >= 25")
    rows = map_partitions_summed(df, _counted, "id long", "n long").collect()
    assert sorted(r.id for r in rows if not r.is_summary) == list(range(25, 100))
    ends = sorted((r.partition, r.n) for r in rows if r.is_summary)
    assert ends == [(0, None), (1, 25), (2, 25), (3, 25)]
    with pytest.raises(ValueError, match="must differ"):
        map_partitions_summed(df, _counted, "id long", "ID long")


def test_repeated_attempts_count_once(spark, folder):
    df = spark.range(40, numPartitions=2)
    summed = map_partitions_summed(df, _counted, "id long", "n long")
    summed.write.parquet(f"{folder}/once")
    once = spark.read.parquet(f"{folder}/once")
    lost = once.filter("not is_summary and partition = 1 and id < 25").withColumn("attempt", F.col("attempt") + 1000)
    again = once.filter("partition = 0").withColumn("attempt", F.col("attempt") + 1000)
    kept = committed(once.unionByName(lost).unionByName(again))
    assert sorted(r.id for r in kept.filter("not is_summary").collect()) == list(range(40))
    assert kept.filter("is_summary").agg(F.sum("n")).first()[0] == 40
