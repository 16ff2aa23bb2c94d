"""The append sink and the keyed cache."""

import json
import os
import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import Files, settings
from tidemark.streaming.append_sink import (
    AppendSink,
    Ledger,
    appended,
    compact,
    expire,
    flag_batches,
    ledger_table,
    retained,
    route,
)
from tidemark.streaming.cache import (
    KeyedCache,
    cache_answers,
    cache_changes,
    cache_state,
    cache_versions,
)

START = datetime(2024, 1, 1, tzinfo=UTC)


def rows(spark, *triples):
    return spark.createDataFrame(list(triples), "path string, text string, n long")


def sink(folder, **options):
    return AppendSink(folder, F.col("path"), F.col("text"), order=[F.col("n")], **options)


def written(spark, folder):
    return sorted(map(tuple, appended(spark, folder).select("batch_id", "out_path", "value").collect()))


def lines_of(folder, path):
    """Lines of a path, its files in the order of their names."""
    base = f"{folder}/out_path={path}"
    lines = []
    for name in sorted(n for n in os.listdir(base) if n.startswith("part-")):
        with open(f"{base}/{name}") as file:
            lines += file.read().splitlines()
    return lines


def test_batches_nulls_and_repeats(spark, folder):
    to = sink(folder)
    first = rows(spark, ("a", "1", 1), (None, "2", 2), ("b", None, 3), ("b/c d", "4", 4))
    assert to.write_batch(first, 0)
    assert not to.write_batch(rows(spark, ("a", "other", 1)), 0)
    assert to.write_batch(rows(spark, ("a", "5", 1)), 1)
    assert written(spark, folder) == [(0, "a", "1"), (0, "b/c d", "4"), (1, "a", "5")]


def test_failed_attempt_is_replaced(spark, folder):
    assert sink(folder).write_batch(rows(spark, ("a", "0", 1)), 0)
    Ledger(spark, folder).add(1, "start", START)
    broken = route(rows(spark, ("a", "half", 1), ("gone", "half", 1)), F.col("path"), F.col("text"))
    broken.write.partitionBy("out_path").text(f"{folder}/data/batch_id=1")
    assert sink(folder).write_batch(rows(spark, ("a", "1", 1)), 1)
    assert written(spark, folder) == [(0, "a", "0"), (1, "a", "1")]


def test_failure_leaves_no_done_record(spark, folder):
    failing = AppendSink(folder, F.col("path"), F.raise_error(F.lit("bad row")).cast("string"))
    with pytest.raises(Exception, match="bad row"):
        failing.write_batch(rows(spark, ("a", "1", 1)), 0)
    assert [r.status for r in ledger_table(spark, folder).collect()] == ["start"]
    with pytest.raises(Exception, match="empty"):
        sink(folder).write_batch(rows(spark, ("", "1", 1)), 0)


def test_settings(spark):
    for options in ({"keep": 0}, {"expiry": "soon"}):
        with pytest.raises(ValueError):
            sink("/x", **options)
    with pytest.raises(ValueError, match="root"):
        sink("")


def test_order_and_compaction(spark, folder):
    to = sink(f"{folder}/s")
    numbers = list(range(3000))
    random.Random(1).shuffle(numbers)
    for batch in range(3):
        # One path holds most of the rows.
        part = [("hot" if n % 10 else "cold", f"{batch}-{n}", n) for n in numbers]
        to.write_batch(rows(spark, *part).repartition(4), batch)
    for batch in range(3):
        got = lines_of(f"{folder}/s/data/batch_id={batch}", "hot")
        assert got == [f"{batch}-{n}" for n in range(3000) if n % 10]
    want = {
        "hot": [f"{b}-{n}" for b in range(3) for n in range(3000) if n % 10],
        "cold": [f"{b}-{n}" for b in range(3) for n in range(0, 3000, 10)],
    }
    compact(spark, f"{folder}/s", f"{folder}/one")
    compact(spark, f"{folder}/s", f"{folder}/many", file_bytes=6000)
    for target in ("one", "many"):
        assert {p: lines_of(f"{folder}/{target}", p) for p in want} == want
    files = [n for n in os.listdir(f"{folder}/one/out_path=hot") if n.startswith("part-")]
    assert len(files) == 1
    files = [n for n in os.listdir(f"{folder}/many/out_path=hot") if n.startswith("part-")]
    assert len(files) > 3


def test_ledger_retention_and_expiry(spark, folder):
    for batch in range(5):
        now = START + timedelta(days=batch)
        to = sink(folder, keep=2, expiry="2.00:00:00", clock=lambda now=now: now)
        to.write_batch(rows(spark, ("a", str(batch), 1)), batch)
    ledger = ledger_table(spark, folder)
    flags = ledger.filter("status <> 'expiry'").select("batch_id", "status").collect()
    assert sorted(map(tuple, flags)) == [(b, s) for b in (2, 3, 4) for s in ("done", "start")]
    # Batches 0 and 1 end on days 2 and 3; the purge of flags keeps their expiry.
    assert expire(spark, folder, START + timedelta(days=3)) == [0, 1]
    assert {b for b, _, _ in written(spark, folder)} == {2, 3, 4}
    assert expire(spark, folder, START + timedelta(days=3)) == []


def test_flag_names(spark):
    names = ["0_0_start", "1_0_start", "1_0_done", "1_3_done", "2_0_done", "x", "9_0_other"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    batches = flag_batches(df, "name")
    assert sorted(r.batch_id for r in batches.collect()) == [0, 1, 2]
    assert sorted(r.batch_id for r in retained(batches, keep=1).collect()) == [1, 2]


def cache(folder, **options):
    return KeyedCache(
        folder, F.col("key"), F.col("op"), F.col("value"), F.col("seq"),
        cache=F.col("cache"), **options,
    )


def commands(spark, rows):
    return spark.createDataFrame(rows, "cache string, key string, op string, value long, seq long")


def replay(batches):
    """The same commands in a plain dictionary."""
    state, answers, versions = {}, {}, []
    for batch in batches:
        ahead, aborted = dict(state), set()
        for name, key, op, value, seq in sorted(batch, key=lambda c: c[4]):
            if op == "put":
                ahead[name, key] = value
            elif op == "remove":
                ahead.pop((name, key), None)
            elif op == "abort":
                aborted.add((name, key))
            else:
                answers[name, key, seq] = ahead.get((name, key))
        for entry in aborted:
            ahead.pop(entry, None)
            if entry in state:
                ahead[entry] = state[entry]
        state = ahead
        versions.append(state)
    return versions, answers


def batches_of_commands(batches=4, size=400):
    """Random commands; one key gets a third of them."""
    chance = random.Random(7)
    result, seq = [], 0
    for _ in range(batches):
        batch = []
        for _ in range(size):
            seq += 1
            key = "hot" if chance.random() < 0.33 else f"k{chance.randrange(40)}"
            op = chance.choices(["put", "get", "remove", "abort"], [40, 40, 18, 1])[0]
            value = chance.choice([None, seq]) if op == "put" else None
            batch.append((chance.choice("xy"), key, op, value, seq))
        chance.shuffle(batch)
        result.append(batch)
    return result


def test_cache_against_a_dictionary(spark, folder):
    batches = batches_of_commands()
    versions, answers = replay(batches)
    to = cache(folder, full_every=2)
    for number, batch in enumerate(batches):
        to.write_batch(commands(spark, batch).repartition(3), number)
    # A batch may come twice; it gives the same result.
    to.write_batch(commands(spark, batches[-1]), len(batches) - 1)
    for number, want in enumerate(versions):
        got = cache_state(spark, folder, number).collect()
        assert {(r.cache, r.key): r.value for r in got} == want
    got = cache_answers(spark, folder).collect()
    assert len(got) == len(answers)
    assert {(r.cache, r.key, r.seq): r.value for r in got} == answers
    changed = cache_changes(spark, folder, 1, 1).select("cache", "key").collect()
    touched = {(n, k) for n, k, op, _, _ in batches[1] if op in ("put", "remove")}
    aborted = {(n, k) for n, k, op, _, _ in batches[1] if op == "abort"}
    assert {tuple(r) for r in changed} == touched - aborted


def test_cache_cuts_a_hot_key(spark, folder):
    to = cache(folder)
    batch = [("x", "hot", "put" if n % 2 else "get", n, n) for n in range(4000)]
    # As small as they are, the slices would be put together again.
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        to.write_batch(commands(spark, batch).repartition(4), 0)
        staged = to._staged(commands(spark, batch).repartition(4), 1)
    sizes = [r["count"] for r in staged.groupBy("slice").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000
    answers = {r.seq: r.value for r in cache_answers(spark, folder).collect()}
    assert answers == {n: n - 1 if n else None for n in range(0, 4000, 2)}


def test_cache_forgets_old_versions(spark, folder):
    to = cache(folder, full_every=2, keep=2)
    for number in range(6):
        to.write_batch(commands(spark, [("x", f"k{number}", "put", number, number)]), number)
    kept = sorted(os.listdir(f"{folder}/changes"))
    assert kept == ["batch_id=4", "batch_id=5"]
    assert sorted(os.listdir(f"{folder}/full")) == ["batch_id=3", "batch_id=5"]
    assert {r.key for r in cache_state(spark, folder).collect()} == {f"k{n}" for n in range(6)}
    assert {r.key for r in cache_state(spark, folder, 4).collect()} == {f"k{n}" for n in range(5)}


def test_cache_ttl(spark, folder):
    df = spark.createDataFrame(
        [("a", "put", 1, 1, 0), ("a", "get", None, 2, 59), ("a", "get", None, 3, 60), ("b", "put", 2, 4, 30)],
        "key string, op string, value long, seq long, second long",
    ).withColumn("at", F.timestamp_seconds("second"))
    to = KeyedCache(
        folder, F.col("key"), F.col("op"), F.col("value"), F.col("seq"), at=F.col("at"), ttl="0:01:00"
    )
    to.write_batch(df, 0)
    answers = {r.seq: r.value for r in cache_answers(spark, folder).collect()}
    assert answers == {2: 1, 3: None}
    alive = cache_state(spark, folder, now=F.timestamp_seconds(F.lit(60)))
    assert [r.key for r in alive.collect()] == ["b"]
    with pytest.raises(ValueError, match="together"):
        cache(folder, ttl="0:01:00")


def test_unknown_operation(spark, folder):
    with pytest.raises(Exception, match="unknown cache operation: pop"):
        cache(folder).write_batch(commands(spark, [("x", "a", "pop", 1, 1)]), 0)


def test_cache_with_null_keys(spark, folder):
    to = cache(folder)
    to.write_batch(commands(spark, [("x", None, "put", 1, 1), ("x", None, "get", None, 2)]), 0)
    to.write_batch(commands(spark, [("x", None, "get", None, 3)]), 1)
    assert {r.seq: r.value for r in cache_answers(spark, folder).collect()} == {2: 1, 3: 1}


def _files_of(frame):
    return sorted(set(x.split("/batch_id=")[1] for x in (f.rsplit("/", 1)[0] for f in frame.inputFiles())))


def test_a_batch_for_one_key_reads_one_bucket(spark, folder):
    to = cache(folder, full_every=3, buckets=8)
    for number in range(6):
        rows = [("x", f"k{n}", "put", number, 100 * number + n) for n in range(40)] if number < 5 else [("x", "k7", "get", None, 900)]
        to.write_batch(commands(spark, rows), number)
    files = Files(spark, folder)
    schema = StructType.fromJson(json.loads(files.text(f"{folder}/schema.json")))
    (bucket,) = {r.bucket for r in spark.createDataFrame([("x", "k7")], "cache string, key string").select(to._bucket().alias("bucket")).collect()}
    one = cache_versions(spark, folder, 4, schema, [bucket])
    assert _files_of(one) == [f"2/bucket={bucket}", f"3/bucket={bucket}", f"4/bucket={bucket}"]
    assert len(_files_of(cache_versions(spark, folder, 4, schema))) == 24
    assert {r.seq: r.value for r in cache_answers(spark, folder).where("seq = 900").collect()} == {900: 4}


def test_only_touched_buckets_get_a_new_base(spark, folder):
    to = cache(folder, full_every=1, keep=2, buckets=8)
    to.write_batch(commands(spark, [("x", f"k{n}", "put", n, n) for n in range(40)]), 0)
    for number in range(1, 5):
        to.write_batch(commands(spark, [("x", "k7", "remove" if number == 1 else "get", None, 100 + number)]), number)
    assert sorted(os.listdir(f"{folder}/base")) == ["batch_id=0", "batch_id=1"]
    assert len([x for x in os.listdir(f"{folder}/base/batch_id=1") if x.startswith("bucket=")]) == 1
    stored = spark.read.parquet(f"{folder}/base/batch_id=1")
    assert "k7" not in {r.key for r in stored.collect()} and {r.op for r in stored.collect()} == {"put"}
    assert {r.key for r in cache_state(spark, folder).collect()} == {f"k{n}" for n in range(40)} - {"k7"}
    to.write_batch(commands(spark, [("x", f"k{n}", "put", 1, 200 + n) for n in range(40)]), 5)
    to.write_batch(commands(spark, []), 6)
    to.write_batch(commands(spark, []), 7)
    assert sorted(os.listdir(f"{folder}/base")) == ["batch_id=5"]
    assert sorted(os.listdir(f"{folder}/full")) == ["batch_id=5", "batch_id=6", "batch_id=7"]
    assert cache_state(spark, folder).count() == 40


def test_a_bucket_that_becomes_empty(spark, folder):
    to = cache(folder, full_every=1, buckets=1)
    to.write_batch(commands(spark, [("x", "a", "put", 1, 1)]), 0)
    to.write_batch(commands(spark, [("x", "a", "remove", None, 2)]), 1)
    to.write_batch(commands(spark, [("x", "a", "get", None, 3)]), 2)
    assert cache_state(spark, folder).count() == 0 and cache_state(spark, folder, 0).count() == 1
    assert [r.value for r in cache_answers(spark, folder).collect()] == [None]


def test_every_entry_has_its_own_time(spark, folder):
    def rows(*every):
        frame = spark.createDataFrame(every, "key string, op string, value long, seq long, second long, ttl long")
        return frame.withColumn("at", F.timestamp_seconds("second"))

    to = KeyedCache(
        folder, F.col("key"), F.col("op"), F.col("value"), F.col("seq"), at=F.col("at"), ttl=F.col("ttl"), full_every=1, buckets=4
    )
    to.write_batch(rows(*[(k, "put", n, n, 0, ttl) for n, (k, ttl) in enumerate([("a", 10), ("b", 20), ("c", None), ("d", 1000)])]), 0)
    to.write_batch(rows(("a", "get", None, 10, 9, None), ("b", "get", None, 11, 15, None), ("a", "get", None, 12, 15, None)), 1)
    # a get that looks back sees no value whose time was up in an earlier batch
    to.write_batch(rows(("a", "get", None, 20, 5, None), ("c", "get", None, 21, 500, None), ("d", "get", None, 22, 999, None)), 2)
    answers = {r.seq: r.value for r in cache_answers(spark, folder).collect()}
    assert answers == {10: 0, 11: 1, 12: None, 20: None, 21: 2, 22: 3}
    assert [sorted(r.key for r in cache_state(spark, folder, v).collect()) for v in range(3)] == [["a", "b", "c", "d"], ["b", "c", "d"], ["c", "d"]]
    # only buckets with a value whose time was up were written again
    where = {r.key: r.bucket for r in spark.createDataFrame([("default", k) for k in "abcd"], "cache string, key string").select("key", to._bucket().alias("bucket")).collect()}
    assert {x for x in os.listdir(f"{folder}/base/batch_id=1") if x.startswith("bucket=")} <= {f"bucket={where['a']}"}
    stored = {r.key for n in (1, 2) if os.path.exists(f"{folder}/base/batch_id={n}") for r in spark.read.schema(StructType().add("key", "string")).parquet(f"{folder}/base/batch_id={n}").collect()}
    assert not stored & {"a", "b"}


def test_bucket_settings(folder):
    with pytest.raises(ValueError, match="buckets"):
        cache(folder, buckets=0)


def test_the_number_of_buckets_is_settled_by_the_first_batch(spark, folder):
    cache(folder, buckets=3).write_batch(commands(spark, [("x", "a", "put", 1, 1)]), 0)
    cache(folder).write_batch(commands(spark, [("x", "a", "get", None, 2)]), 1)
    assert [r.value for r in cache_answers(spark, folder).collect()] == [1]
    with pytest.raises(ValueError, match="3 buckets, not 5"):
        cache(folder, buckets=5).write_batch(commands(spark, [("x", "a", "get", None, 3)]), 2)
