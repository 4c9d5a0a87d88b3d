import numpy as np
import pytest
from pyspark.sql import functions as F

from subscope.operators import oversampling
from subscope.operators.oversampling import balanced, leaves, neighbours, standard_rows, synthetic_rows

from .conftest import plan_of

COLUMNS = [f"f{i}" for i in range(19)]


def points_frame(spark, x):
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "row long, point array<double>").repartition(4)


def exact(x, k):
    far = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(far, np.inf)
    return np.argsort(far, axis=1, kind="stable")[:, :k]


def test_recall_of_neighbours(spark):
    """Nineteen features that six hidden ones move, as minutes, calls and charges do."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 6)) @ rng.normal(size=(6, 19)) + 0.2 * rng.normal(size=(4000, 19))
    found = neighbours(points_frame(spark, x), 19, k=5, leaf_rows=400).collect()
    got = {}
    for r in found:
        got.setdefault(r["row"], set()).add(r["other"])
        assert abs(r["distance"] - np.linalg.norm(x[r["row"]] - x[r["other"]])) < 1e-9
    assert len(got) == 4000 and all(len(v) == 5 for v in got.values())
    recall = np.mean([len(got[i] & set(own)) / 5 for i, own in enumerate(exact(x, 5).tolist())])
    assert recall >= 0.9


def test_leaves_are_bounded_also_for_equal_rows(spark):
    x = np.zeros((1000, 3))
    sizes = leaves(points_frame(spark, x), 3, trees=2, leaf_rows=100).groupBy("tree", "node").count().collect()
    assert sum(r["count"] for r in sizes) == 2000 and max(r["count"] for r in sizes) <= 110


def test_few_rows(spark):
    assert neighbours(points_frame(spark, np.zeros((1, 2))), 2).collect() == []
    three = neighbours(points_frame(spark, np.array([[0.0, 0], [0, 1], [0, 3]])), 2).orderBy("row", "rank").collect()
    assert [(r["row"], r["rank"], r["other"]) for r in three] == [(0, 1, 1), (0, 2, 2), (1, 1, 0), (1, 2, 2), (2, 1, 1), (2, 2, 0)]
    assert neighbours(points_frame(spark, np.zeros((0, 2))), 2).collect() == []


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(700):
        values = [float(v) for v in rng.normal(size=19)]
        values[4] = 7.0
        rows.append((f"c{i}", int(i % 10 == 0), *values))
    rows[10] = (*rows[10][:-1], None)
    fields = ", ".join(f"{c} double" for c in COLUMNS)
    return spark.createDataFrame(rows, f"customer_id string, churn int, {fields}").repartition(4)


def test_new_rows_lie_between_their_parents(spark, table):
    out = balanced(table, features=COLUMNS, trees=4, leaf_rows=32)
    known = {r["customer_id"]: r for r in table.collect()}
    old, new = out.where("parent is null").collect(), out.where("parent is not null").collect()
    rare = [i for i, r in known.items() if r["churn"] == 1 and r["f18"] is not None]
    assert len(old) == 699 and len(new) == len(rare) * (630 // len(rare) - 1)
    for r in new:
        a, b = known[r["parent"]], known[r["neighbour"]]
        assert r["churn"] == a["churn"] == b["churn"] == 1 and r["customer_id"] is None and 0 <= r["gap"] < 1
        assert r["parent"] != r["neighbour"]
        for c in COLUMNS:
            assert abs(r[c] - (a[c] + r["gap"] * (b[c] - a[c]))) < 1e-12
    per_parent = {i: sum(r["parent"] == i for r in new) for i in rare}
    assert set(per_parent.values()) == {630 // len(rare) - 1}
    # Not all new rows of a parent go to one neighbour.
    assert len({(r["parent"], r["neighbour"]) for r in new}) > 2 * len(rare)


def test_same_rows_again(spark, table):
    again = [sorted(map(tuple, synthetic_rows(table.where("churn = 1"), 2, COLUMNS, trees=2, leaf_rows=16).collect())) for _ in range(2)]
    assert again[0] == again[1]


def test_lone_row_one_class_and_none(spark, table):
    one = table.where("customer_id = 'c0'")
    assert [(r["parent"], r["neighbour"]) for r in synthetic_rows(one, 2, COLUMNS).collect()] == [("c0", "c0")] * 2
    assert synthetic_rows(one, 0, COLUMNS).collect() == []
    assert balanced(table.where("churn = 0"), features=COLUMNS).count() == 630
    assert balanced(table.limit(0), features=COLUMNS).collect() == []
    with pytest.raises(ValueError, match="two classes"):
        balanced(table.withColumn("churn", F.pmod(F.xxhash64("customer_id"), F.lit(4)).cast("int")), features=COLUMNS)


def test_scale_does_not_choose_the_neighbours(spark, table):
    wide = table.withColumn("f0", F.col("f0") * 1000)
    first, second = (standard_rows(t.where("churn = 1"), COLUMNS).select("key", "point").collect() for t in (table, wide))
    second = {r["key"]: r["point"] for r in second}
    assert all(np.allclose(r["point"], second[r["key"]]) for r in first)


def test_nothing_is_written_on_the_way_down(spark, monkeypatch):
    """Groups of several tasks and the levels within them; no table of rows and trees is kept."""
    written = []
    monkeypatch.setattr(oversampling, "_written", lambda df, name: written.append(name) or df)
    monkeypatch.setattr(oversampling, "GROUP_LEAVES", 4)
    x = np.random.default_rng(5).normal(size=(3000, 3)).round(1)
    x[:400] = 0.0
    sizes = leaves(points_frame(spark, x), 3, trees=2, leaf_rows=50).groupBy("tree", "node").count().collect()
    assert sum(r["count"] for r in sizes) == 6000 and max(r["count"] for r in sizes) <= 60 and len(sizes) > 100
    found = neighbours(points_frame(spark, x[400:]), 3, k=3, leaf_rows=100).collect()
    assert written == [] and len(found) == 3 * 2600
    got = {}
    for r in found:
        got.setdefault(r["row"], []).append(r["distance"])
    far = np.sqrt(np.sort(((x[400:, None] - x[None, 400:]) ** 2).sum(axis=2), axis=1))[:, 1:4]
    assert np.mean([np.allclose(sorted(got[i]), far[i]) for i in range(2600)]) >= 0.9


def test_a_few_trees_at_a_time_find_the_same(spark, monkeypatch):
    """What earlier trees have found is written in one piece per row, and its files go when the
    next ones are; a write leaves no shuffle files and the session's setting as it was."""
    monkeypatch.setattr(oversampling, "TREES_AT_ONCE", 2)
    written, real = [], oversampling._written
    monkeypatch.setattr(oversampling, "_written", lambda df, name: written.append(real(df, name)) or written[-1])
    x = np.random.default_rng(7).normal(size=(600, 4)).round(1)
    points = points_frame(spark, x).cache()
    expected = {(r["row"], r["rank"]): (r["other"], r["distance"]) for r in neighbours(points, 4, 3, 5, 40).collect()}
    found = oversampling._neighbours_in_steps(points, 4, 3, 5, 40)
    got = {(r["row"], i + 1): pair for r in found.collect() for i, pair in enumerate(zip(r["others"], r["distances"]))}
    assert got == expected and len(written) == 3 and spark.conf.get(oversampling.CLEANED) == "false"
    paths = [spark._jvm.org.apache.hadoop.fs.Path(t.inputFiles()[0]) for t in written]
    there = [p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) for p in paths]
    assert there == [False, False, True]
    points.unpersist()


def test_rows_of_the_table_are_not_joined(spark):
    """New rows know that their gap is set, so that the two sides of the table are told apart
    without making the new rows twice."""
    rows = [(f"c{i}", int(i % 5 == 0), *(float(i * j % 17) for j in range(1, 20))) for i in range(60)]
    df = spark.createDataFrame(rows, f"customer_id string, churn int, {', '.join(f'{c} double' for c in COLUMNS)}")
    out = balanced(df, features=COLUMNS, trees=2, leaf_rows=16)
    assert "Join" not in plan_of(out.where("gap is null")) and "Union" not in plan_of(out.where("gap is not null"))
    assert out.where("gap is null").count() == 60 and out.where("gap is not null").count() == 12 * 3
