import json

import pytest
from pyspark.sql import functions as F

from subscope.streaming import quarantine
from subscope.streaming.decode import enrich
from subscope.streaming.sources import read_text_files

GOOD = {"customer_id": "cust_1", "timestamp": "2024-01-01T00:00:07.179575Z", "call_duration": 1.5, "roaming": 1}


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def failing(spark, value, **options):
    (row,) = quarantine.parted(frame(spark, [value]), **options).collect()
    return row["failing"]


@pytest.mark.parametrize(
    "value, names",
    [
        (json.dumps(GOOD), []),
        (json.dumps(GOOD | {"roaming": "often"}), ["roaming"]),
        (json.dumps(GOOD | {"roaming": "often", "call_duration": {"s": 1}}), ["call_duration", "roaming"]),
        (json.dumps(GOOD | {"timestamp": "yesterday"}), ["timestamp"]),
        (json.dumps(GOOD | {"roaming": None, "beyond": [1]}), []),
        ("{}", []),
        ("{bad", [quarantine.RECORD]),
        ("[1]", [quarantine.RECORD]),
        ("", [quarantine.RECORD]),
        (None, [quarantine.RECORD]),
    ],
)
def test_failing_fields_are_named(spark, value, names):
    assert failing(spark, value) == names


def test_required_fields(spark):
    assert failing(spark, "{}", required=["customer_id"]) == ["customer_id"]
    assert failing(spark, '{"customer_id": null}', required=["customer_id"]) == ["customer_id"]
    with pytest.raises(ValueError):
        quarantine.parted(frame(spark, ["{}"]), required=["no_such"])


def test_binary_records_and_positions(spark):
    df = frame(spark, ["{bad"]).select(F.col("value").cast("binary"), F.lit(7).alias("offset"), F.lit("t").alias("topic"))
    (row,) = quarantine.parted(df, position=[F.col("topic"), F.col("offset")]).collect()
    assert row["raw"] == "{bad" and json.loads(row["position"]) == {"topic": "t", "offset": 7}


def test_good_and_bad_are_the_input_after_a_restart(spark, tmp_path):
    source, good, bad, checkpoint = (str(tmp_path / n) for n in ("in", "good", "bad", "checkpoint"))
    rows = [json.dumps(GOOD | {"customer_id": f"cust_{i}"} | ({"roaming": "x"} if i % 4 == 1 else {})) if i % 5 else "{bad" for i in range(100)]
    for start in (0, 50):
        frame(spark, rows[start : start + 50]).write.mode("append").text(source)
        for _ in range(2):  # the second run finds nothing new
            quarantine.write_parted_stream(
                read_text_files(spark, source), good, bad, checkpoint, position=[F.col("_metadata.file_path").alias("file")], transform=enrich, available_now=True
            ).awaitTermination()
    kept, rest = quarantine.read_batches(spark, good).collect(), quarantine.read_batches(spark, bad).collect()
    assert sorted([r["customer_id"] for r in kept]) == sorted(f"cust_{i}" for i in range(100) if i % 5 and i % 4 != 1)
    assert sorted(r["raw"] for r in rest) == sorted(r for i, r in enumerate(rows) if i % 5 == 0 or i % 4 == 1)
    assert all(r["failing"] == (["<record>"] if r["raw"] == "{bad" else ["roaming"]) and "file" in r["position"] for r in rest)
    assert {"processing_time", "is_roaming"} <= set(kept[0].asDict())


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    both = quarantine.parted(frame(spark, [json.dumps(GOOD), json.dumps(GOOD), "{bad"]))
    for _ in range(2):
        quarantine.write_batch(both, 3, good, bad)
    quarantine.write_batch(both.where("false"), 4, good, bad)
    assert quarantine.read_batches(spark, good).count() == 2 and quarantine.read_batches(spark, bad).count() == 1
