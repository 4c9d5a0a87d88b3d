import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subscope.operators import moments
from subscope.operators.cleaning import SigmaCapper
from subscope.operators.correlation import correlation_matrix
from subscope.operators.profile import column_stats

NAMES = ["a", "b", "big", "same", "none"]


@pytest.fixture(scope="module")
def table(spark):
    r, rows = random.Random(4), []
    for i in range(800):
        a = r.gauss(0, 3)
        rows.append((i, a, None if i % 5 == 0 else 2 * a + r.random(), 1e9 + r.random(), 7.1, None))
    rows.append((800, float("nan"), 1.0, 1e9, 7.1, None))
    rows.append((801, float("inf"), 2.0, 1e9, 7.1, None))
    return spark.createDataFrame(rows, "id long, a double, b double, big double, same double, none double").repartition(5)


def figures(df):
    return {(r["a"], r["b"]): tuple(r)[2:] for r in df.collect()}


def close(x, y, scale=1e-9):
    if x is None or y is None:
        return x is y
    return math.isclose(x, y, rel_tol=scale, abs_tol=1e-9)


@pytest.mark.parametrize("parts", [1, 2, 9])
def test_merged_parts_equal_one_pass(spark, table, tmp_path, parts):
    path = str(tmp_path / "moments")
    for i in reversed(range(parts)):
        moments.store_part(table.where(F.col("id") % parts == i), path, str(i), NAMES)
    moments.store_part(table.where("id < 0"), path, "empty", NAMES)
    moments.store_part(table.where(F.col("id") % parts == 0), path, "0", NAMES)
    one, many = figures(moments.part_moments(table, NAMES)), figures(moments.merged(moments.stored(spark, path)))
    assert set(one) == set(many) and len(one) == 15
    # Means near 10^9 are known to seven places only.
    bad = [(k, x, y) for k in one for x, y in zip(one[k], many[k]) if not close(x, y, 1e-5 if "big" in k else 1e-9)]
    assert not bad
    # Merged by halves first, the figures are the same again.
    table_ = moments.stored(spark, path)
    halves = moments.merged(table_.where("part < '3'")).unionByName(moments.merged(table_.where("part >= '3'")))
    twice = figures(moments.merged(halves))
    assert all(close(x, y, 1e-5 if "big" in k else 1e-9) for k in one for x, y in zip(one[k], twice[k]))


def test_profile_bounds_and_correlation_equal_the_passes(spark, table):
    found = moments.part_moments(table, NAMES)
    profile = {r["column"]: r for r in moments.profile(found).collect()}
    for r in column_stats(table, NAMES).collect():
        own = profile[r["column"]]
        assert close(own["mean"], r["mean"]) and close(own["std"], r["std"], 1e-6) and own["row_count"] == r["row_count"]
    assert profile["a"]["null_count"] == 1 and profile["a"]["known"] == 800 and profile["none"]["mean"] is None
    assert abs(profile["big"]["std"] - np.sqrt(1 / 12)) < 0.02
    capper = SigmaCapper(columns=NAMES)
    for x, y in zip(sorted(moments.bounds(found, capper).bounds, key=lambda b: b.column), sorted(capper.fit(table).bounds, key=lambda b: b.column)):
        assert x.column == y.column and all(close(p, q, 1e-7) for p, q in zip((x.mean, x.lower, x.upper), (y.mean, y.lower, y.upper)))
    finite = table.where("id < 800")
    matrix = moments.correlation(moments.part_moments(finite, NAMES), NAMES)
    expected = {(r["row_name"], r["column_name"]): r for r in correlation_matrix(finite, NAMES).collect()}
    got = matrix.collect()
    assert len(got) == 25
    for r in got:
        other = expected[r["row_name"], r["column_name"]]
        assert close(r["correlation"], other["correlation"], 1e-6) and r["row_index"] == other["row_index"]


def test_a_new_part_is_all_that_is_read(spark, table, tmp_path):
    path = str(tmp_path / "moments")
    moments.store_part(table.where("id < 400"), path, "first", NAMES)
    before = figures(moments.merged(moments.stored(spark, path)))
    moments.store_part(table.where("id >= 400"), path, "second", NAMES)
    after = moments.merged(moments.stored(spark, path))
    assert all(after.inputFiles()) and {f.split("part=")[1].split("/")[0] for f in after.inputFiles()} == {"first", "second"}
    assert before != figures(after) and figures(after)["a", "a"][6] == 802


def test_empty_table_and_no_columns(spark, table):
    (row,) = moments.profile(moments.part_moments(table.where("false"), ["a"])).collect()
    assert row["row_count"] == row["known"] == 0 and row["mean"] is row["std"] is row["min"] is None
    assert moments.part_moments(table.select(F.lit("x").alias("x"))).collect() == []
