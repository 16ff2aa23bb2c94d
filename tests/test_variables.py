"""Processors with several state variables and timers."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import SINGLE_WATERMARK, with_watermark
from tidemark.operators.variables import VariableCounts, process_groups
from tidemark.session import settings, state_settings
from tidemark.streaming.checkpoints import state_table, state_timers
from tidemark.streaming.running import into_table, run_available

SCHEMA = "user long, kind string, n long, time timestamp"
GAP_MS = 10_000


def counts(spark, folder, **options):
    rows = with_watermark(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), "time", "0 seconds")
    processor = VariableCounts("kind", "n", "time", GAP_MS)
    return process_groups(rows, ["user"], processor, "user long, total long, closed boolean", **options)


def test_timers_end_move_and_start_anew(spark, folder):
    batches = [
        [(1, "a", 2, 100), (1, None, 1, 101), (2, "a", 5, 100), (None, "b", 1, 101)],
        [(1, "b", 1, 108), (2, None, 0, 90)],
        [(3, "a", 1, 115)],
        [(2, "a", 7, 120), (1, "a", 1, 117)],
    ]
    with settings(spark, state_settings(spark, **SINGLE_WATERMARK)):
        for rows in batches:
            frame = spark.createDataFrame(rows, "user long, kind string, n long, s long")
            frame.select("user", "kind", "n", F.timestamp_seconds("s").alias("time")).write.mode("append").parquet(f"{folder}/in")
            run_available(into_table(counts(spark, folder, time="event"), f"{folder}/out", "update"), f"{folder}/checkpoint")
    got = [tuple(r) for r in spark.read.parquet(f"{folder}/out").select("user", "total", "closed").collect()]
    want = [
        (1, 3, False), (2, 5, False), (None, 1, False),
        # The second batch's row of 2 is late: the watermark stood at 101.
        (1, 4, False),
        (3, 1, False),
        # 115 passed the end of 2 and of the null key, but not that of 1, which had moved to 118.
        (2, 5, True), (None, 1, True),
        (2, 7, False), (1, 5, False),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    # State of the last batch: 2 began anew, the map of 1 holds null kinds as the empty one.
    checkpoint = f"{folder}/checkpoint"
    kinds = state_table(spark, checkpoint, variable="kinds").select("key.user", "user_map_key.kind", "user_map_value.n")
    assert {tuple(r) for r in kinds.collect()} == {
        (1, "a", 3), (1, "", 1), (1, "b", 1), (2, "a", 7), (3, "a", 1),
    }
    timers = state_timers(spark, checkpoint).select("key.user", "expires_ms")
    assert {tuple(r) for r in timers.collect()} == {(1, 127_000), (2, 130_000), (3, 125_000)}


def test_bad_options(spark, folder):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/in")
    with pytest.raises(ValueError, match="mode"):
        counts(spark, folder, mode="complete")
    with pytest.raises(ValueError, match="time"):
        counts(spark, folder, time="later")


def test_one_state_call_a_variable_and_kind():
    import pandas as pd

    calls = []

    class Held:
        def __init__(self, name):
            self.name, self.value, self.map = name, None, {}

        def __getattr__(self, method):
            def call(*args):
                calls.append((self.name, method))
                if method == "get":
                    return self.value
                if method == "exists":
                    return self.value is not None
                if method == "update":
                    self.value = args[0]
                if method == "getValue":
                    return self.map.get(args[0])
                if method == "containsKey":
                    return args[0] in self.map
                if method == "updateValue":
                    self.map[args[0]] = args[1]

            return call

    class Handle:
        def getValueState(self, name, schema):
            return Held(name)

        getMapState = lambda self, name, key, value: Held(name)
        registerTimer = deleteTimer = lambda self, ms: calls.append(("timer", ms))

    processor = VariableCounts("kind", "n", "time", GAP_MS)
    processor.init(Handle())
    chunk = pd.DataFrame({"kind": ["a", None, "a"], "n": [1, 2, 3], "time": pd.to_datetime([1000, 2000, 3000], unit="ms", utc=True)})
    for step in range(2):
        calls.clear()
        (row,) = processor.handleInputRows((7,), iter([chunk]), None)
        assert row.values.tolist() == [[7, 6 * (step + 1), False]]
        reads = [c for c in calls if c[1] in ("get", "exists", "getValue", "containsKey")]
        assert len(reads) == 4, reads  # total, two kinds, last
