import random

import pytest
from pyspark.sql import functions as F

from subscope.operators import sketches
from subscope.operators.quantiles import exact_quantiles
from subscope.plans import queries
from subscope.schemas import FEATURES

from .conftest import plan_of

NAMES = ["a", "heavy", "same"]


@pytest.fixture(scope="module")
def table(spark):
    r = random.Random(5)
    rows = [(i, int(i % 3 == 0), r.gauss(0, 3), float(r.choice([0, 0, 0, 1, 2, 9])), 7.0) for i in range(30_000)]
    rows += [(30_000, 1, float("nan"), None, None), (30_001, 1, float("inf"), None, 7.0)]
    return spark.createDataFrame(rows, "id long, churn int, a double, heavy double, same double").repartition(6).cache()


def parts(spark, table, path, order):
    for i in order:
        sketches.store_part(table.where(F.col("id") % 9 == i), path, f"p{i}", NAMES)
    return sketches.stored(spark, path)


def ranks_are_close(table, found, probabilities):
    values = {}
    for r in table.collect():
        for c in NAMES:
            if r[c] is not None and r[c] - r[c] == 0:
                values.setdefault((r["churn"], c), []).append(r[c])
    slack = 2 * sketches.rank_error()
    rows = sketches.quantiles(found, probabilities).collect()
    assert len(rows) == 6 * len(probabilities)
    for r in rows:
        own = values[r["churn"], r["column"]]
        assert r["n"] == len(own) and r["value"] in own
        below, to = (sum(f) / len(own) for f in ([v < r["value"] for v in own], [v <= r["value"] for v in own]))
        assert below - slack <= r["probability"] <= to + slack
        if r["probability"] in (0, 1):
            assert r["value"] == (max if r["probability"] else min)(own)


def test_parts_merge_in_any_order_and_grouping(spark, table, tmp_path):
    probabilities = [0, 0.01, 0.25, 0.5, 0.75, 0.99, 1]
    for name, order in (("up", range(9)), ("down", [*reversed(range(9)), 4])):
        found = parts(spark, table, str(tmp_path / name), order)
        assert found.select("part").distinct().count() == 9
        ranks_are_close(table, sketches.merged(found), probabilities)
        halves = sketches.merged(found.where("part < 'p4'")).unionByName(sketches.merged(found.where("part >= 'p4'")))
        ranks_are_close(table, sketches.merged(halves), probabilities)


def test_boxes_are_near_the_exact_ones(table):
    found = {(r["churn"], r["column"]): r for r in sketches.boxes(sketches.part_sketches(table, NAMES)).collect()}
    for (label, index), o in exact_quantiles(table, NAMES, (0.25, 0.5, 0.75), "churn").items():
        r = found[label, NAMES[index]]
        assert (r["count"], r["low"], r["high"]) == (o.count, o.low, o.high)
        if NAMES[index] == "a":
            assert all(abs(r[q] - o.quantile(p)) < 0.2 for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)))
            outside = table.where(F.col("churn") == label).where(f"a < {r['fence_low']} or a > {r['fence_high']} and a < 1e9").count()
            assert abs(r["outliers_about"] - outside) <= 4 * sketches.rank_error() * o.count
    assert found[0, "same"]["outliers_about"] == 0


def test_histogram_counts_ties_in_their_own_bin(table):
    rows = sketches.histogram(sketches.part_sketches(table, NAMES), bins=9).collect()
    totals = {}
    for r in rows:
        totals[r["churn"], r["column"]] = totals.get((r["churn"], r["column"]), 0) + r["count_about"]
        assert r["count_about"] >= 0
    assert totals[0, "a"] == 20_000 and totals[1, "heavy"] == 10_000 and totals[1, "same"] == 10_001
    for r in rows:
        if r["column"] == "heavy":
            inside = (F.col("heavy") >= r["left"]) & (F.col("heavy") < (r["right"] if r["bin"] < 8 else 10))
            assert abs(r["count_about"] - table.where((F.col("churn") == r["churn"]) & inside).count()) <= 4 * sketches.rank_error() * 20_000


def test_empty_table_and_wrong_bins(table):
    none = sketches.part_sketches(table.where("false"), NAMES)
    assert sketches.boxes(none).collect() == [] == sketches.merged(none).collect()
    with pytest.raises(ValueError):
        sketches.histogram(none, bins=0)


def test_over_all_classes(table):
    (row,) = sketches.merged(sketches.part_sketches(table, ["a"]), label=None).collect()
    assert row["n"] == 30_000 and row["low"] < row["high"]


def lineitems(spark, path, copies=40):
    """A small lineitem table, whose doubles sit on bin edges too."""
    rows = spark.range(7 * copies).select(
        *(F.col("id").alias(c) for c in ("l_orderkey", "l_partkey", "l_suppkey")),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") % 31 * 1.0).alias("l_quantity"),
        (F.col("id") * 100.0).alias("l_extendedprice"),
        (F.col("id") % 11 / 100).alias("l_discount"),
        (F.col("id") % 9 / 100).alias("l_tax"),
        F.element_at(F.array(*map(F.lit, "ANR")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"),
    )
    rows.write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_values_meet_their_histogram_without_a_row_per_bin(spark, tmp_path):
    """a value is looked up in one row of its class and column, which is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = queries.sketched_histogram(spark, lineitems(spark, tmp_path))
        plan = plan_of(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan
    rows = found.collect()
    assert len(rows) == 2 * len(FEATURES)
    assert all(r["rows"] == r["counted"] > 0 and r["bins_within"] == 1 for r in rows)


def test_values_are_not_shuffled_to_their_boxes(spark):
    """the boxes are broadcast, also where Spark cannot tell their size."""
    values = spark.createDataFrame([(i % 2, *[float(i)] * len(FEATURES)) for i in range(101)], ["churn", *FEATURES])
    boxes = spark.createDataFrame([(0, c, 24.5, 50.0, 75.5) for c in FEATURES], "churn int, column string, q1 double, median double, q3 double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = queries._ranks_within(values, boxes, 0.01)
        plan = plan_of(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {tuple(r) for r in found.collect()} == {(0, c, 51, 1) for c in FEATURES}
