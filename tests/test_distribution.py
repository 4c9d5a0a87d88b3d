import math
import random
import re

import numpy as np
import pandas as pd
import pytest

from subscope.operators.distribution import (
    automatic_bins,
    box_stats_by_label,
    density_by_label,
    histogram_by_label,
)
from subscope.operators.quantiles import class_bins, class_summary, exact_quantiles

from .conftest import plan_of


def labelled(spark, pairs, kind="int"):
    return spark.createDataFrame(pairs, f"churn {kind}, v double").repartition(4)


def skewed(n=3000, seed=1):
    """A third of the rows is one value; the rest has a heavy tail."""
    r = random.Random(seed)
    values = [5.0 if i % 3 == 0 else math.exp(r.gauss(0, 3)) for i in range(n)]
    return [(int(i % 5 == 0), v) for i, v in enumerate(values)]


CASES = {
    "skewed": [v for _, v in skewed()],
    "constant": [2.5] * 40,
    "one": [3.0],
    "two": [1.0, 2.0],
    "huge": [-1.7e308, 1.7e308, 0.0, 1.0, -1.0, 2.0],
    "tiny": [5e-324, 1e-323, 2e-323, 0.0, 1.0],
    "signed": [-3.0, -0.0, 0.0, 1.0, 7.0, -8.0],
    "neighbours": [1.0, math.nextafter(1.0, 2.0), math.nextafter(1.0, 0.0), 1.0],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("bins", [2, 1024])
def test_quantiles_are_exact(spark, name, bins):
    if name == "skewed" and bins == 2:
        bins = 16
    values = CASES[name]
    df = labelled(spark, [(0, v) for v in values])
    found = exact_quantiles(df, ["v"], (0.0, 0.25, 0.5, 0.9, 1.0), bins=bins)[0, 0]
    ordered = sorted(values)
    for rank, value in found.at_rank.items():
        assert value == ordered[rank]
    assert len(found.at_rank) >= 1


def test_quantiles_leave_out_missing_and_infinite(spark):
    values = [1.0, 2.0, None, math.nan, math.inf, 3.0]
    df = labelled(spark, [(0, v) for v in values])
    found = exact_quantiles(df, ["v"], (0.5,))[0, 0]
    assert (found.count, found.quantile(0.5)) == (3, 2.0)


def test_box_statistics_by_brute_force(spark):
    pairs = skewed()
    got = {r["churn"]: r for r in box_stats_by_label(labelled(spark, pairs)).collect()}
    for label in (0, 1):
        x = np.array([v for c, v in pairs if c == label])
        q1, median, q3 = np.percentile(x, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = x[(x >= low) & (x <= high)]
        r = got[label]
        assert r["count"] == len(x)
        assert [r["q1"], r["median"], r["q3"]] == pytest.approx([q1, median, q3])
        assert r["whisker_low"] == min(inside.min(), q1)
        assert r["whisker_high"] == max(inside.max(), q3)
        assert r["outliers"] == len(x) - len(inside)


def test_box_of_text_and_null_classes(spark):
    df = labelled(spark, [("a", 1.0), ("a", 3.0), (None, 7.0), (None, 9.0)], "string")
    got = {r["churn"]: r["median"] for r in box_stats_by_label(df).collect()}
    assert got == {"a": 2.0, None: 8.0}


def test_approximate_boxes_are_close(spark):
    df = labelled(spark, skewed())
    exact = {r["churn"]: r for r in box_stats_by_label(df).collect()}
    for r in box_stats_by_label(df, method="approx").collect():
        assert r["median"] == pytest.approx(exact[r["churn"]]["median"], rel=0.05)
    with pytest.raises(ValueError):
        box_stats_by_label(df, method="guess")


def test_approximate_boxes_sketch_no_values(spark):
    """quartiles with ranks within the accuracy, from counts in bins."""
    values = np.random.default_rng(12).lognormal(size=30_000)
    df = labelled(spark, [(0, v) for v in values.tolist()])
    found = box_stats_by_label(df, method="approx", accuracy=200)
    (row,) = found.collect()
    for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        assert abs((values <= row[name]).mean() - p) <= 1 / 200 + 2 / len(values)
    summary = class_summary(df, ["v"], "churn")
    box_stats_by_label(df, method="approx", accuracy=200, summary=summary)
    assert all(not o.at_rank for o in summary.values())
    near = exact_quantiles(df, ["v"], (0.5,), "churn", tolerance=1 / 200)
    assert near[0, 0].quantile(0.5) == row["median"]


def test_histogram_equals_numpy(spark):
    r = random.Random(2)
    pairs = [(int(r.random() < 0.3), float(r.randrange(0, 50))) for _ in range(2000)]
    got = histogram_by_label(labelled(spark, pairs), bins=7).toPandas()
    everything = np.array([v for _, v in pairs])
    for label in (0, 1):
        x = np.array([v for c, v in pairs if c == label])
        counts, edges = np.histogram(x, 7, (everything.min(), everything.max()))
        density, _ = np.histogram(x, edges, density=True)
        mine = got[got.churn == label].sort_values("bin")
        assert mine["count"].tolist() == counts.tolist()
        assert mine["bin_low"].tolist() == pytest.approx(edges[:-1].tolist())
        assert mine["bin_high"].tolist() == pytest.approx(edges[1:].tolist())
        assert mine["density"].tolist() == pytest.approx(density.tolist())


def test_automatic_bins(spark):
    r = np.random.default_rng(3)
    for values in (r.normal(size=1500), r.uniform(size=200), r.exponential(size=900)):
        edges = np.histogram_bin_edges(values, "auto")
        occupied = int((np.histogram(values, edges)[0] > 0).sum())
        got = histogram_by_label(labelled(spark, [(0, v) for v in values.tolist()]))
        assert got.count() == occupied
    # Without an interquartile range the Sturges width decides: log2(100) + 1, rounded up.
    assert automatic_bins(100, 0.0, 1.0, 0.0) == 8
    assert automatic_bins(10, 2.0, 2.0, 0.0) == 1


def test_histogram_densities_integrate_to_one(spark):
    df = labelled(spark, skewed() + [(0, None), (1, math.nan)])
    rows = histogram_by_label(df, bins=13).toPandas()
    area = (rows.density * (rows.bin_high - rows.bin_low)).groupby(rows.churn).sum()
    assert area.tolist() == pytest.approx([1.0, 1.0])
    assert (rows["count"] == 0).any()


def test_histogram_of_a_constant_column(spark):
    rows = histogram_by_label(labelled(spark, [(0, 4.0)] * 5), bins=4).collect()
    assert sum(r["count"] for r in rows) == 5
    assert min(r["bin_low"] for r in rows) == 3.5


def kernel_density(x, grid):
    h = np.std(x, ddof=1) * len(x) ** (-0.2)
    z = (grid[:, None] - x[None, :]) / h
    return np.exp(-0.5 * z * z).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))


def test_exact_density_does_not_move_the_values(spark):
    """F8: what meets the grid are cells of the bandwidth, however many distinct values there
    are, and the densities stay exact, far from all values too."""
    values = np.random.default_rng(8).normal(size=20_000).tolist() + [40.0]
    df = labelled(spark, [(0, v) for v in values])
    found = density_by_label(df, resolution=None)
    got = found.sort("point").toPandas()
    x = np.array(values)
    want = kernel_density(x, np.linspace(x.min(), x.max(), 200))
    assert np.allclose(got.density, want, rtol=1e-9, atol=1e-280)
    dealt_by = re.findall(r"hashpartitioning\((.*)\)", plan_of(found))
    assert dealt_by and not any("_value" in keys for keys in dealt_by)


def test_density_by_brute_force(spark):
    r = random.Random(4)
    pairs = [(int(r.random() < 0.4), r.gauss(0, 2)) for _ in range(400)]
    everything = [v for _, v in pairs]
    grid = np.linspace(min(everything), max(everything), 200)
    exact = density_by_label(labelled(spark, pairs), resolution=None).toPandas()
    rough = density_by_label(labelled(spark, pairs), resolution=500).toPandas()
    for label in (0, 1):
        want = kernel_density(np.array([v for c, v in pairs if c == label]), grid)
        got = exact[exact.churn == label].sort_values("point")
        assert got["x"].tolist() == pytest.approx(grid.tolist(), abs=1e-12)
        assert got["density"].tolist() == pytest.approx(want.tolist(), rel=1e-9)
        near = rough[rough.churn == label].sort_values("point")
        assert near["density"].tolist() == pytest.approx(want.tolist(), abs=1e-4)


def test_flat_class_has_no_curve(spark):
    df = labelled(spark, [(0, 1.0), (0, 2.0), (1, 5.0), (1, 5.0), (2, 3.0)])
    assert {r["churn"] for r in density_by_label(df, grid=10).collect()} == {0}


def test_no_pair_of_rows_is_formed(spark, tmp_path):
    labelled(spark, skewed(200)).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for frame in (
        histogram_by_label(df, bins=5),
        density_by_label(df, resolution=50),
        box_stats_by_label(df),
    ):
        text = plan_of(frame)
        assert "NestedLoop" not in text and "Cartesian" not in text
        assert "EvalPython" not in text and "InPandas" not in text
    assert isinstance(histogram_by_label(df, bins=5).toPandas(), pd.DataFrame)


@pytest.mark.parametrize("tail", [1e5, 1e12, 1e300])
def test_automatic_bins_of_a_heavy_tail(spark, tail):
    values = [i / 100 for i in range(2000)] + [tail]
    rows = histogram_by_label(labelled(spark, [(0, v) for v in values])).collect()
    assert sum(r["count"] for r in rows) == 2001
    assert 1 < len(rows) <= 2001 and all(r["count"] > 0 for r in rows)
    for r in rows:
        assert r["bin_low"] <= r["bin_high"]
    with pytest.raises(ValueError):
        histogram_by_label(labelled(spark, [(0, 1.0)]), empty_bins=True)


def test_too_many_classes_are_refused(spark, monkeypatch):
    from subscope.operators import longform

    monkeypatch.setattr(longform, "MAX_CLASS_COLUMNS", 3)
    with pytest.raises(ValueError):
        box_stats_by_label(labelled(spark, [(i, 1.0) for i in range(5)]))


def test_shared_bins_give_the_same_report(spark):
    """one binned pass serves quartiles, boxes and densities; only cut bins are read again."""
    pairs = skewed()
    rows = [(c, v, 3.0, None if i % 7 == 0 else float(c)) for i, (c, v) in enumerate(pairs)]
    rows += [(2, 5.0, 3.0, 8.0), (2, 5.0, 3.0, None), (3, None, None, None)]
    df = spark.createDataFrame(rows, "churn int, v double, flat double, per_class double")
    names = ["v", "flat", "per_class"]
    for number in (1, 7, 4096):
        plain = class_summary(df, names, "churn")
        shared = class_summary(df, names, "churn")
        binned = class_bins(df, names, "churn", shared, number)
        for method in ("exact", "approx"):
            a = box_stats_by_label(df, columns=names, method=method, summary=plain)
            b = box_stats_by_label(df, columns=names, method=method, summary=shared, binned=binned)
            if method == "exact":
                assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
            else:
                assert b.count() == a.count()
        a = histogram_by_label(df, columns=names, summary=plain).collect()
        b = histogram_by_label(df, columns=names, summary=shared, binned=binned).collect()
        assert sorted(map(str, a)) == sorted(map(str, b))
        a = density_by_label(df, columns=names, resolution=number, summary=plain)
        b = density_by_label(df, columns=names, resolution=number, summary=shared, binned=binned)
        a, b = ({tuple(r)[:3]: r["density"] for r in t.collect()} for t in (a, b))
        assert a.keys() == b.keys() and all(b[k] == pytest.approx(a[k]) for k in a)


@pytest.mark.parametrize("case", ["huge", "tiny"])
def test_shared_bins_of_extreme_values(spark, case):
    df = labelled(spark, [(0, v) for v in CASES[case]])
    summary = class_summary(df, ["v"], "churn")
    binned = class_bins(df, ["v"], "churn", summary, 4096)
    found = exact_quantiles(df, ["v"], (0.25, 0.5), "churn", summary, counted=binned)[0, 0]
    assert found.quantile(0.5) == exact_quantiles(df, ["v"], (0.5,), "churn")[0, 0].quantile(0.5)
