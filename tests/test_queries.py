"""Named queries against their SQL, and the plans of some of them."""

import os

import duckdb
import pytest

from tidemark.plans import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
FAST = [
    "append_compact",
    "append_compact_twice",
    "append_expired",
    "append_replay",
    "batchlog_compressed",
    "batchlog_range",
    "batchlog_stream_partitions",
    "batchlog_partitions",
    "batchlog_steps",
    "batchlog_set_changes",
    "batchlog_tables_new",
    "batchlog_tables_set",
    "cache_abort",
    "cache_entry_timeout",
    "flatmap_batch",
    "group_by_computed_key",
    "late_rows_dropped",
    "ledger_retention",
    "map_partitions_projection",
    "output_expiry",
    "partition_hook",
    "partition_local_groups",
    "reader_acknowledged",
    "state_lifecycle_timeout",
    "state_metrics",
    "state_timers",
    "state_variables",
    "timeout_batches",
    "watermark_audit_daily",
    "watermark_combined",
]

pytestmark = pytest.mark.skipif(not os.path.exists(DATA), reason="no test data")


@pytest.mark.parametrize("name", FAST)
def test_same_rows_as_sql(spark, name):
    frame = QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    with duckdb.connect() as database:
        for table in ("events", "orders"):
            database.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
        names = ", ".join(f'"{column}"' for column in columns)
        want = database.execute(f"select {names} from ({ORACLES[name]})").fetchall()
    got = [tuple(row) for row in frame.select(*columns).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["partition_local_groups"](spark, DATA)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange") == 1


def test_partition_local_groups_folds_by_columns(spark, folder):
    """Many users interleaved in every partition, a null user: rows as the SQL, and no
    Python call per user and chunk, so the merge of partials is Spark's own aggregate."""
    with duckdb.connect() as database:
        database.execute(
            f"""copy (select i as event_id, case when i % 997 = 0 then null else i % 5000 end as user_id
                from range(60000) t(i)) to '{folder}/events.parquet' (format parquet, row_group_size 8000)"""
        )
        want = database.execute(
            f"select user_id, count(*), min(event_id), max(event_id) from '{folder}/events.parquet' group by user_id"
        ).fetchall()
    frame = QUERIES["partition_local_groups"](spark, folder)
    got = [tuple(row) for row in frame.select("user_id", "n", "first_id", "last_id").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Sort" not in plan
