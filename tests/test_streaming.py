import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from subscope.plans import queries
from subscope.plans.streams import run_stream, start_stream
from subscope.schemas import EVENT_SCHEMA
from subscope.streaming.decode import decode_json, enrich
from subscope.streaming.scoring import attach_scores, unique_scores, write_scored_stream
from subscope.streaming.sinks import write_parquet_stream
from subscope.streaming.sources import (
    kafka_options,
    read_kafka,
    read_record_files,
    read_text_files,
)

GOOD = {
    "customer_id": "cust_1",
    "timestamp": "2024-01-01T00:00:07.179575Z",
    "call_duration": 1.5,
    "call_type": "local",
    "roaming": 1,
}


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def decoded(spark, *values):
    return decode_json(texts(spark, values)).collect()


def test_well_formed_record(spark):
    row = decoded(spark, json.dumps(GOOD))[0]
    assert row["customer_id"] == "cust_1"
    assert row["timestamp"] == datetime(2024, 1, 1, 0, 0, 7, 179575)
    assert row["sms_count"] is None


def test_malformed_records_become_rows_of_nulls(spark):
    rows = decoded(spark, "{bad", None, "[]", "")
    assert len(rows) == 4
    assert all(value is None for row in rows for value in row)


def test_wrong_types_touch_their_field_only(spark):
    rows = decoded(
        spark,
        json.dumps({**GOOD, "roaming": "x"}),
        json.dumps({**GOOD, "roaming": 1.0}),
        json.dumps({**GOOD, "customer_id": 17}),
    )
    assert [r["roaming"] for r in rows] == [None, None, 1]
    assert [r["customer_id"] for r in rows] == ["cust_1", "cust_1", "17"]


def test_malformed_records_can_be_dropped(spark):
    df = texts(spark, ["{bad", json.dumps(GOOD), None])
    assert decode_json(df, on_malformed="drop").count() == 1
    with pytest.raises(ValueError):
        decode_json(df, on_malformed="fail")


def test_binary_values(spark):
    df = texts(spark, [json.dumps(GOOD)]).select(F.col("value").cast("binary"))
    assert decode_json(df).first()["call_duration"] == 1.5


def test_roaming_flag_and_processing_time(spark):
    df = texts(spark, [json.dumps({**GOOD, "roaming": r}) for r in (1, 0, None)])
    rows = enrich(decode_json(df)).collect()
    assert [r["is_roaming"] for r in rows] == [1, 0, None]
    assert all(r["processing_time"] == r["timestamp"] for r in rows)


def write_events(spark, path, numbers, mode="append"):
    values = [json.dumps({**GOOD, "customer_id": f"cust_{n}"}) for n in numbers]
    texts(spark, [*values, "{bad"]).write.mode(mode).text(path)


def test_stream_equals_batch(spark, tmp_path):
    events, out = str(tmp_path / "events"), str(tmp_path / "out")
    write_events(spark, events, range(40))
    ended = run_stream(
        read_text_files(spark, events), out, str(tmp_path / "cp"), available_now=True
    )
    assert ended
    stream = spark.read.parquet(out)
    batch = enrich(decode_json(spark.read.text(events)))
    assert stream.columns == [*EVENT_SCHEMA.names, "processing_time", "is_roaming"]
    assert stream.exceptAll(batch).count() == 0 == batch.exceptAll(stream).count()


def test_restart_adds_nothing_twice(spark, tmp_path):
    events, out, cp = (str(tmp_path / n) for n in ("events", "out", "cp"))
    for numbers, total in ((range(10), 11), (range(10, 25), 27), (None, 27)):
        if numbers is not None:
            write_events(spark, events, numbers)
        run_stream(read_text_files(spark, events, 1), out, cp, available_now=True)
        assert spark.read.parquet(out).count() == total


def test_query_runs_until_stopped(spark, tmp_path):
    events = str(tmp_path / "events")
    write_events(spark, events, range(3))
    query = start_stream(
        read_text_files(spark, events),
        str(tmp_path / "out"),
        str(tmp_path / "cp"),
        interval="1 second",
    )
    query.processAllAvailable()
    assert query.isActive and not query.awaitTermination(0.1)
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_only_append_is_accepted(spark, tmp_path):
    stream = spark.readStream.schema("value string").json(str(tmp_path))
    for mode in ("update", "complete"):
        with pytest.raises(ValueError):
            write_parquet_stream(stream, "out", "cp", mode)
    with pytest.raises(ValueError):
        run_stream(stream, "out", "cp", output_mode="complete")


def test_record_files_are_a_source(spark, tmp_path):
    path = str(tmp_path / "records")
    texts(spark, [json.dumps(GOOD)]).select(F.col("value").cast("binary")).write.parquet(
        path
    )
    assert read_record_files(spark, path, 1).schema.simpleString() == "struct<value:binary>"


def test_kafka_options():
    assert kafka_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    more = kafka_options("h:1", "t", max_offsets_per_trigger=5, min_partitions=9)
    assert (more["maxOffsetsPerTrigger"], more["minPartitions"]) == ("5", "9")


def test_missing_kafka_connector_is_named(spark):
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_kafka(spark, kafka_options("localhost:1", "t"))


def test_one_score_per_customer(spark):
    rows = [("a", 0.0, 0.2, True), ("a", 1.0, 0.9, True), ("a", None, None, False), ("b", None, None, False), (None, 1.0, 0.8, True)]
    df = spark.createDataFrame(rows, "customer_id string, prediction double, probability double, complete boolean")
    unique = sorted(tuple(r) for r in unique_scores(df).collect())
    assert unique == [("a", 1.0, 0.9, True), ("b", None, None, False)]
    events = spark.createDataFrame([("a", 1), ("a", 1), ("c", 2), (None, 3), (None, 3)], "customer_id string, n int")
    got = sorted((r["n"], r["probability"]) for r in attach_scores(events, unique_scores(df)).collect())
    assert got == [(1, 0.9), (1, 0.9), (2, None), (3, None), (3, None)]


def test_scores_are_looked_up_and_batches_replaced(spark, tmp_path):
    events, out, scores = (str(tmp_path / n) for n in ("events", "out", "scores"))
    write_events(spark, events, [1, 1, 1, 2])
    found = spark.createDataFrame([("cust_1", 0.9)], "customer_id string, probability double")
    found.write.parquet(scores)
    for checkpoint in ("cp1", "cp2"):  # the second run repeats batch 0
        write_scored_stream(
            enrich(decode_json(read_text_files(spark, events))),
            scores,
            out,
            str(tmp_path / checkpoint),
            available_now=True,
        ).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 5
    assert sum(r["probability"] == 0.9 for r in rows) == 3


def test_decoding_stays_in_generated_code(spark, tmp_path):
    from .conftest import plan_of

    write_events(spark, str(tmp_path / "events"), range(3))
    text = plan_of(enrich(decode_json(spark.read.text(str(tmp_path / "events")))))
    assert "Python" not in text and "Exchange" not in text


def test_micro_batches_do_not_grow_with_the_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "FILE_RECORDS", 8)
    monkeypatch.setattr(queries, "scratch_path", lambda _, name: str(tmp_path / name))
    counted = queries.stream_parquet_sink(spark, "/root/testdata/sf0.001").collect()
    files = [f for f in os.listdir(tmp_path / "events") if f.endswith(".txt")]
    commits = [f for f in os.listdir(tmp_path / "checkpoint" / "commits") if f.isdigit()]
    assert len(files) > 2 * queries.MICRO_BATCHES
    assert 1 < len(commits) <= queries.MICRO_BATCHES
    assert sum(r["records"] for r in counted) == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
