from datetime import datetime, timedelta

import pandas as pd

from tidemark.operators import with_watermark
from tidemark.plans.watermark_queries import late_rows_kept
from tidemark.streaming.running import into_table, run_available


def test_calls_do_not_grow_with_users(spark, folder):
    start = datetime(2024, 1, 1)
    rows = [(user, user * 2 + i, start + timedelta(minutes=user)) for user in range(60) for i in range(2)]
    rows.append((None, 1000, start))
    spark.createDataFrame(rows, "user_id long, event_id long, ts timestamp").write.parquet(f"{folder}/in")

    def calls(key, chunks, state):
        # One row per call: how many rows it saw.
        yield pd.DataFrame({"event_id": [sum(len(chunk) for chunk in chunks)]})

    stream = spark.readStream.schema("user_id long, event_id long, ts timestamp").parquet(f"{folder}/in")
    kept = late_rows_kept(with_watermark(stream, "ts", "36 hours"), calls)
    run_available(into_table(kept, f"{folder}/out"), f"{folder}/checkpoint")
    seen = [row.event_id for row in spark.read.parquet(f"{folder}/out").collect()]

    assert sum(seen) == len(rows)
    assert len(seen) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
