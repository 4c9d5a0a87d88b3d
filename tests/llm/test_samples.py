"""Samples are bounded by rows, whatever repeats."""

from pyspark.sql import functions as F

from subscope.llm import common, pii

ROWS = 50_000


def repeated(spark):
    """One id on very many rows with texts of their own, and some others."""
    text = F.concat(F.lit("call +49 170 1234567 or mail a"), F.col("id").cast("string"), F.lit("@b.org now"))
    one = spark.range(0, ROWS, 1, 8).select(F.lit(7).cast("long").alias("doc_id"), text.alias("text"))
    return one.unionByName(spark.range(10).select(F.col("id").alias("doc_id"), F.lit("some text 12").alias("text")))


def test_one_row_of_each_id(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    sample = common.labelled_sample(repeated(spark), labels, "quality", 100).collect()
    assert sorted(r["doc_id"] for r in sample) == list(range(10))
    again = common.labelled_sample(repeated(spark).repartition(3), labels, "quality", 100).collect()
    assert sorted(map(tuple, sample)) == sorted(map(tuple, again))


def test_islands_of_one_row(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "train", seen.extend)
    pii.fit(repeated(spark))
    assert 0 < len(seen) <= 10 * pii.SAMPLE_ISLANDS


def test_islands_by_hash_not_by_place():
    text = " ".join(f"word x{i}9 word" for i in range(100))
    starts = [s for s, *_ in pii.labelled_islands(text)]
    assert len(starts) == pii.SAMPLE_ISLANDS and starts == sorted(starts) and starts[-1] > len(text) // 2
