import pytest
from pyspark.sql import functions as F

from subscope.schemas import ID
from subscope.streaming import keyed
from subscope.streaming.keyed import PROVIDER, ROCKSDB, changes_from, kept_scores, with_latest_scores, write_keyed_stream

EVENTS = f"{ID} string, seq long, note string"
CHANGES = f"{ID} string, made_at timestamp, prediction double, probability double, extra string"


@pytest.fixture(autouse=True)
def provider(spark):
    spark.conf.set(PROVIDER, ROCKSDB)
    yield
    spark.conf.unset(PROVIDER)


class Streams:
    """Folders of events and changes, and the query over both."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)
        self.add([], [])

    def add(self, events, changes):
        self.spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(f"{self.path}/events")
        made = self.spark.createDataFrame([(k, str(t), a, b, "x") for k, t, a, b in changes], CHANGES.replace("timestamp", "string"))
        made = made.withColumn("made_at", F.timestamp_seconds(F.col("made_at").cast("long")))
        made.coalesce(1).write.mode("append").parquet(f"{self.path}/changes")

    def run(self):
        read = self.spark.readStream
        changes = changes_from(read.schema(CHANGES).parquet(f"{self.path}/changes"), "made_at")
        events = read.schema(EVENTS).parquet(f"{self.path}/events")
        write_keyed_stream(events, changes, f"{self.path}/out", f"{self.path}/checkpoint", available_now=True).awaitTermination()
        return {r["seq"]: (r[ID], r["note"], r["prediction"], r["probability"]) for r in self.spark.read.parquet(f"{self.path}/out").collect()}

    def state(self):
        return {r[ID]: (r["prediction"], r["probability"]) for r in kept_scores(self.spark, f"{self.path}/checkpoint").collect()}


def test_latest_scores_over_restarts(spark, tmp_path):
    streams = Streams(spark, tmp_path)
    big = 2**60 + 1
    streams.add([("a", 1, "n"), ("b", 2, None), (None, 3, "no customer"), ("c", big, "z")], [("a", 10, 1.0, 0.9), ("a", 5, 0.0, 0.1), ("b", 7, 0.0, 0.2), (None, 8, 1.0, 1.0)])
    out = streams.run()
    assert out == {1: ("a", "n", 1.0, 0.9), 2: ("b", None, 0.0, 0.2), 3: (None, "no customer", None, None), big: ("c", "z", None, None)}
    assert streams.state() == {"a": (1.0, 0.9), "b": (0.0, 0.2)}
    # A restart: a late change and a repeated one do nothing, a newer one counts.
    streams.add([("a", 11, "n"), ("b", 12, "n"), ("c", 13, "n")], [("a", 9, 0.0, 0.3), ("b", 7, 0.0, 0.2), ("c", 1, 1.0, 0.7), ("b", 20, 1.0, 0.6)])
    out = streams.run()
    assert len(out) == 7
    assert [out[i][2:] for i in (11, 12, 13)] == [(1.0, 0.9), (1.0, 0.6), (1.0, 0.7)]
    assert out[2][2:] == (0.0, 0.2)
    # Nothing new: nothing is written twice.
    assert streams.run() == out
    # A change without prediction takes the score away.
    streams.add([("a", 21, "n")], [("a", 30, None, None)])
    assert streams.run()[21][2:] == (None, None)
    assert streams.state() == {"a": (None, None), "b": (1.0, 0.6), "c": (1.0, 0.7)}


def test_changes_of_the_same_order(spark, tmp_path):
    """The order in which they come does not matter, within a batch or over batches."""
    streams = Streams(spark, tmp_path)
    streams.add([], [("a", 1, 0.0, 0.2), ("a", 1, 1.0, 0.8), ("b", 1, 1.0, 0.8)])
    streams.run()
    streams.add([("a", 1, "n"), ("b", 2, "n")], [("b", 1, 0.0, 0.2), ("a", 1, None, None)])
    out = streams.run()
    assert out[1][2:] == out[2][2:] == (1.0, 0.8)


def test_one_customer_with_very_many_events(spark, tmp_path):
    streams = Streams(spark, tmp_path)
    streams.add([("a", i, "n") for i in range(5000)] + [(None, 5000 + i, "n") for i in range(3000)], [("a", 1, 1.0, 0.5)])
    out = streams.run()
    assert len(out) == 8000 and {v[2] for k, v in out.items() if k < 5000} == {1.0}
    assert {v[2] for k, v in out.items() if k >= 5000} == {None}


def test_wrong_settings_are_named(spark, tmp_path):
    streams = Streams(spark, tmp_path)
    events = spark.readStream.schema(EVENTS).parquet(f"{streams.path}/events")
    changes = changes_from(spark.readStream.schema(CHANGES).parquet(f"{streams.path}/changes"), "made_at")
    with pytest.raises(ValueError, match="already have"):
        with_latest_scores(events.withColumn("probability", F.lit(1.0)), changes)
    spark.conf.unset(PROVIDER)
    with pytest.raises(ValueError, match="RocksDB"):
        with_latest_scores(events, changes)


def test_customers_of_a_micro_batch_share_states(spark, tmp_path, monkeypatch):
    """F2: there are as many states as buckets, and each customer keeps its own score in them."""
    monkeypatch.setattr(keyed, "BUCKETS", 4)
    streams = Streams(spark, tmp_path)
    streams.add([], [(f"c{i}", t, float(t), i / 100) for i in range(100) for t in (3, 1, 2)])
    streams.run()
    held = spark.read.format("statestore").option("stateVarName", "latest").load(f"{streams.path}/checkpoint")
    assert 1 <= held.count() <= 4
    assert streams.state() == {f"c{i}": (3.0, i / 100) for i in range(100)}
    streams.add([(f"c{i}", i, "n") for i in range(101)] + [(None, 200, "n")], [("c7", 4, 4.0, 0.5)])
    out = {k: v[2:] for k, v in streams.run().items()}
    assert out == {**{i: (3.0, i / 100) for i in range(100)}, 7: (4.0, 0.5), 100: (None, None), 200: (None, None)}
