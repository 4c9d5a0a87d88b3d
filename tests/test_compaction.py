import json

import pytest
from pyspark.sql import functions as F

from subscope.streaming import compaction


def rows_of(df):
    return sorted(tuple(r) for r in df.select("id", "text").collect())


@pytest.fixture
def table(spark, tmp_path):
    """Ten small batches, as a stream leaves them, and an empty store."""
    path, store = str(tmp_path / "table"), str(tmp_path / "store")
    for n in range(10):
        batch = spark.range(n * 5, n * 5 + 5).select("id", F.concat(F.lit("t"), "id").alias("text"))
        batch.write.parquet(f"{path}/batch_id={n}")
    return path, store, [(i, f"t{i}") for i in range(50)]


def read(spark, table):
    return rows_of(compaction.read_table(spark, *table[:2]))


def test_same_rows_before_and_after_and_few_files(spark, table):
    path, store, rows = table
    small = set(compaction.read_table(spark, path, store).inputFiles())
    assert read(spark, table) == rows
    entry = compaction.compact(spark, path, store)
    assert (entry.first, entry.last) == (0, 8)
    after = compaction.read_table(spark, path, store)
    assert rows_of(after) == rows
    kept = spark.read.parquet(f"{store}/ranges/{entry.folder}").inputFiles()
    assert len(kept) < len(small) / 4


def test_killed_compaction_leaves_nothing_that_is_read(spark, table):
    path, store, rows = table
    orphan = compaction.write_range(spark, path, store, 0, 8)
    assert compaction.manifest(spark, store) == []
    assert read(spark, table) == rows
    entry = compaction.compact(spark, path, store)
    assert entry.folder != orphan.folder
    assert read(spark, table) == rows
    # Nine batches and the orphan go, the newest batch and the range stay.
    assert compaction.expire(spark, path, store) == 10
    assert read(spark, table) == rows
    assert compaction.expire(spark, path, store) == 0


def test_reader_of_the_old_manifest(spark, table):
    path, store, rows = table
    old = compaction.read_table(spark, path, store)
    compaction.compact(spark, path, store)
    assert rows_of(old) == rows
    assert rows_of(compaction.read_table(spark, path, store, entries=[])) == rows


def test_newest_batch_may_run_again(spark, table):
    path, store, rows = table
    compaction.compact(spark, path, store)
    again = spark.createDataFrame([(45, "again")], "id long, text string")
    again.write.mode("overwrite").parquet(f"{path}/batch_id=9")
    assert read(spark, table) == sorted(rows[:45] + [(45, "again")])


def test_ranges_follow_each_other(spark, table):
    path, store, rows = table
    first = compaction.compact(spark, path, store)
    assert compaction.compact(spark, path, store) is None
    for n in (10, 12, 13):
        spark.createDataFrame([(100 + n, None)], "id long, text string").write.parquet(f"{path}/batch_id={n}")
    second = compaction.compact(spark, path, store)
    assert (second.first, second.last) == (9, 12)
    compaction.expire(spark, path, store)
    assert [e.first for e in compaction.manifest(spark, store)] == [0, 9]
    found = compaction.read_table(spark, path, store)
    assert found.count() == 53 and found.where("id >= 100").count() == 3
    assert first in compaction.manifest(spark, store)


def test_two_jobs_on_one_range(spark, table):
    path, store, rows = table
    entries = [compaction.write_range(spark, path, store, 0, last) for last in (8, 7, 8)]
    for entry in entries:
        compaction.commit(spark, store, entry)
    assert len(compaction.manifest(spark, store)) == 1
    assert read(spark, table) == rows


def test_stream_restarts_after_a_compaction(spark, tmp_path):
    source, path, store, check = (str(tmp_path / n) for n in ("source", "table", "store", "check"))
    for step in range(3):
        for part in range(4):
            lines = [json.dumps({"id": 10 * step + part, "text": "x"})]
            spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(source)
        stream = spark.readStream.schema("id long, text string").option("maxFilesPerTrigger", 1).json(source)
        compaction.write_batches(stream, path, check, available_now=True).awaitTermination()
        compaction.compact(spark, path, store)
        if step == 1:
            compaction.expire(spark, path, store)
    expected = sorted((10 * s + p, "x") for s in range(3) for p in range(4))
    assert rows_of(compaction.read_table(spark, path, store)) == expected
