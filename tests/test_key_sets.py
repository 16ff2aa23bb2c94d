"""Many keys a call: the same rows as a call per key, in a number of calls that doesn't grow with the keys."""

import os
import random
import sys
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.operators import SINGLE_WATERMARK, flat_map_groups, with_watermark
from tidemark.operators.groups import BUCKETS, KeyStates
from tidemark.plans import timeout_queries
from tidemark.session import settings, state_settings
from tidemark.streaming.checkpoints import state_table
from tidemark.streaming.running import into_table, run_once, run_steps

# The functions below run in workers, which cannot import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

START = datetime(2024, 1, 1)
GAP_MS = 3_600_000
SCHEMA = "k string, g long, id long, ts timestamp"
OUTPUT = "k string, g long, change string, n long"
MERGE = {"id": "max", "rows": "sum", "ts": "max"}
WIDE = 2**53 + 1


def file_steps(spark, folder, steps):
    """A stream of one step a batch."""
    os.makedirs(folder)
    for i, rows in enumerate(steps):
        frame = pd.DataFrame(rows, columns=["k", "g", "id", "ts"])
        frame["g"] = pd.array([row[1] for row in rows], "Int64")
        frame["ts"] = frame["ts"].dt.tz_localize("UTC").astype("datetime64[us, UTC]")
        frame.to_parquet(f"{folder}/{i}.parquet")
        os.utime(f"{folder}/{i}.parquet", (1_700_000_000 + 10 * i,) * 2)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    return with_watermark(stream.withColumn("rows", F.lit(1).cast("long")), "ts", "2 hours")


def millis(times):
    return times.dt.tz_localize(None).astype("datetime64[ms]").astype("int64")


def by_key(key, chunks, state):
    n = state.get[0] if state.exists else None
    if state.hasTimedOut:
        state.remove()
        change = "timed out"
    else:
        chunk = pd.concat(list(chunks))
        last_id = int(chunk["id"].max())
        if last_id % 4 == 0:
            change, n = "removed", None
            state.remove()
        elif last_id % 4 == 1:
            change = "touched"
        else:
            change, n = "updated", (n or 0) + len(chunk)
            state.update((n,))
        # Spark's Python form keeps the old timeout where a call changes nothing at all; so none does here.
        if last_id % 7 or change == "touched":
            state.setTimeoutTimestamp(int(millis(chunk["ts"]).max()) + GAP_MS)
    k, g = (None if pd.isna(part) else part for part in key)
    yield pd.DataFrame({"k": [k], "g": pd.array([g], "Int64"), "change": [change], "n": pd.array([n], "Int64")})


def by_set(keys, rows, states):
    if states.hasTimedOut:
        yield keys.assign(change="timed out", n=states.get["n"])
        states.remove()
        return
    digit = rows["id"] % 4
    states.remove(digit == 0)
    states.update({"n": states.get["n"].fillna(0) + rows["rows"]}, digit > 1)
    states.setTimeoutTimestamp(millis(rows["ts"]) + GAP_MS, (rows["id"] % 7 != 0) | (digit == 1))
    change = np.select([digit == 0, digit == 1], ["removed", "touched"], "updated")
    yield keys.assign(change=change, n=states.get["n"])


def random_steps():
    rng, steps, number = random.Random(5), [], 0
    names = [("a", 1), ("a", None), (None, 1), (None, None), ("b", WIDE), ("b", WIDE - 1), ("c", -1), ("", 0)]
    for step in range(9):
        rows = []
        for _ in range(14):
            number += 1
            # Whole half hours, so that a timeout may be the watermark itself; some rows are late.
            at = START + timedelta(minutes=60 * step + 30 * rng.randrange(-5, 3))
            rows.append((*rng.choice(names[: 8 - step % 3 * 2]), number, at))
        steps.append(rows)
    return steps


def test_same_rows_as_a_call_per_key(spark, folder):
    found = {}
    for name, function, more in (("key", by_key, {}), ("set", by_set, {"merge": MERGE, "buckets": 2})):
        stream = file_steps(spark, f"{folder}/in-{name}", random_steps())
        kept = flat_map_groups(stream, ["k", "g"], function, OUTPUT, "n long", "update", "event", **more)
        with settings(spark, state_settings(spark, **SINGLE_WATERMARK)):
            run_steps(into_table(kept, f"{folder}/{name}", "update"), f"{folder}/checkpoint-{name}")
        rows = spark.read.parquet(f"{folder}/{name}").select("batch_id", "k", "g", "change", "n").collect()
        found[name] = sorted(map(tuple, rows), key=str)
    assert {row[3] for row in found["key"]} == {"removed", "touched", "updated", "timed out"}
    assert {row[2] for row in found["key"]} >= {None, WIDE, WIDE - 1}
    assert found["set"] == found["key"]


def test_calls_of_the_timeout_queries_do_not_grow_with_keys(spark, folder):
    users = 3 * BUCKETS
    rows = [("x", user, user, START + timedelta(minutes=user % 60)) for user in range(users)]
    partial = file_steps(spark, f"{folder}/in", [rows])
    names = {"user_id": "g", "event_type": "k", "last_id": "id", "n": "rows", "slot": "ts"}
    partial = partial.select(*(F.col(old).alias(new) for new, old in names.items()))

    def calls(keys, rows, states):
        # One row per call: how many keys it saw.
        yield pd.DataFrame({"n": [len(keys)]})

    merge = {"n": "sum", "last_id": "max", "slot": "max"}
    seen = [row.n for row in timeout_queries._run(spark, partial, calls, "n long", "n long", merge).collect()]
    assert sum(seen) == users
    assert len(seen) <= BUCKETS


def test_state_of_every_key_goes_on_after_restart(spark, folder):
    steps = [[("a", 1, 2, START), ("b", None, 3, START)], [("a", 1, 6, START), ("c", 5, 7, START)]]
    stream = file_steps(spark, f"{folder}/in", steps)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for changed in (partitions, str(int(partitions) * 2)):
        kept = flat_map_groups(stream, ["k", "g"], by_set, OUTPUT, "n long", "update", "event", merge=MERGE)
        with settings(spark, state_settings(spark, **SINGLE_WATERMARK) | {"spark.sql.shuffle.partitions": changed}):
            run_once(into_table(kept, f"{folder}/out", "update"), f"{folder}/checkpoint")
            run_once(into_table(kept, f"{folder}/out", "update"), f"{folder}/checkpoint")
    state = state_table(spark, f"{folder}/checkpoint").select("value.groupState.*")
    zipped = F.arrays_zip("k", "g", "exists", "n", "timeout_ms")
    held = state.select(F.explode(zipped).alias("s")).select("s.k", "s.g", "s.exists", "s.n")
    assert sorted(map(tuple, held.collect())) == [("a", 1, True, 2), ("b", None, True, 1), ("c", 5, True, 1)]


def test_many_keys_a_call_on_a_table(spark):
    df = spark.createDataFrame([("a", 1, 2, START), ("a", 1, 3, START), (None, None, 6, START)], SCHEMA)
    rows = flat_map_groups(
        df.withColumn("rows", F.lit(1).cast("long")), ["k", "g"], by_set, OUTPUT, "n long", timeout="event", merge=MERGE
    )
    assert sorted(map(tuple, rows.collect()), key=str) == [("a", 1, "updated", 2), (None, None, "updated", 1)]


def test_key_states_and_arguments_are_checked(spark):
    def states(mark):
        return KeyStates(pd.DataFrame({"n": pd.array([1, None], "Int64")}), np.array([True, False]), False, mark)

    with pytest.raises(ValueError, match="columns"):
        states(0).update({"m": 1})
    for ms in (0, 9):
        with pytest.raises(ValueError, match="watermark"):
            states(10).setTimeoutTimestamp(ms)
    with pytest.raises(ValueError, match="off"):
        states(None).setTimeoutTimestamp(1)
    one = states(10)
    one.update({"n": pd.Series([7, 8], dtype="Int64")}, [False, True])
    one.remove([True, False])
    one.setTimeoutTimestamp([10, 11], [False, True])
    assert one.get["n"].to_numpy(object, na_value=None).tolist() == [None, 8]
    assert one.exists.tolist() == [False, True] and one.timeouts.tolist() == [-1, 11]

    df = spark.createDataFrame([("a", 1.5, 1)], "k string, d double, id long")
    arguments = {"function": by_set, "output": OUTPUT, "state": "n long"}
    with pytest.raises(ValueError, match="merged by"):
        flat_map_groups(df, ["k"], **arguments, merge={"id": "avg"})
    with pytest.raises(ValueError, match="event time only"):
        flat_map_groups(df, ["k"], **arguments, merge={"id": "max"}, timeout="processing")
    with pytest.raises(ValueError, match="must be of"):
        flat_map_groups(df, ["d"], **arguments, merge={"id": "max"})
    with pytest.raises(ValueError, match="come twice"):
        flat_map_groups(df, ["k"], by_set, OUTPUT, "k long", merge={"id": "max"})
