"""Reports of streams as a table."""

from tidemark.session import settings
from tidemark.streaming import progress
from tidemark.streaming.running import into_table, run_available

BATCHES = 20
FEW = {"spark.sql.shuffle.partitions": "1", "spark.sql.streaming.numRecentProgressUpdates": "5"}


def test_more_batches_than_spark_keeps(spark, folder):
    for i in range(BATCHES):
        with open(f"{folder}/{i}.json", "w") as file:
            file.write(f'{{"id": {i}, "at": "2024-01-01T00:{i:02}:00Z"}}\n')
    with settings(spark, FEW), progress.recorded(spark, f"{folder}/reports") as table:
        rows = spark.readStream.schema("id long, at timestamp").option("maxFilesPerTrigger", 1).json(f"{folder}/*.json")
        seen = rows.withWatermark("at", "1 day").dropDuplicatesWithinWatermark(["id"])
        query = run_available(into_table(seen, f"{folder}/out"), f"{folder}/checkpoint")
        table.wait(query)
    assert len(query.recentProgress) <= 5
    kept = sorted((row.batch_id, row.rows_updated) for row in progress.metrics(spark, f"{folder}/reports").collect())
    assert [row for row in kept if row[1]] == [(i, 1) for i in range(BATCHES)]
    assert [batch for batch, _ in kept] == list(range(len(kept)))
    marks = progress.watermarks(spark, f"{folder}/reports").orderBy("batch_id").collect()
    assert [m.watermark_ms for m in marks[1:]] == [m.next_watermark_ms for m in marks[:-1]]


def test_nothing_reported_yet(spark, folder):
    assert progress.metrics(spark, f"{folder}/none").count() == 0
    assert progress.watermarks(spark, f"{folder}/none").count() == 0
