import math

import numpy as np
import pandas as pd
import pytest

from subscope.operators.correlation import correlation_lower, correlation_matrix


def wide(frame):
    return frame.toPandas().pivot(
        index="row_name", columns="column_name", values="correlation"
    )


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(5)
    a = rng.normal(1e6, 1.0, 800)
    b = a * 0.5 + rng.normal(0, 1, 800)
    c = rng.exponential(3, 800)
    b[::7] = np.nan
    c[::3] = np.nan
    flat = np.full(800, 0.1)
    only = np.where(np.arange(800) % 7 == 0, c, np.nan)
    return pd.DataFrame({"a": a, "b": b, "c": c, "flat": flat, "only": only})


def spark_table(spark, table):
    rows = [
        tuple(None if math.isnan(v) else float(v) for v in r)
        for r in table.itertuples(index=False)
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in table))


def test_pairwise_complete_like_pandas(spark, table):
    got = wide(correlation_matrix(spark_table(spark, table)))
    want = table.corr()
    for i in table:
        for j in table:
            w, g = want.loc[i, j], got.loc[i, j]
            if math.isnan(w):
                assert g is None or math.isnan(g)
            else:
                assert g == pytest.approx(w, abs=1e-9)


def test_symmetric_bounded_and_one_on_the_diagonal(spark, table):
    got = wide(correlation_matrix(spark_table(spark, table)))
    for i in ("a", "b", "c"):
        assert got.loc[i, i] == 1.0
        for j in ("a", "b", "c"):
            assert got.loc[i, j] == got.loc[j, i]
            assert abs(got.loc[i, j]) <= 1.0


def test_column_constant_where_the_other_is_present(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0), (2.0, 5.0), (3.0, None), (9.0, None)], "x double, y double"
    )
    df2 = spark.createDataFrame(
        [(1.0, 5.0), (1.0, 6.0), (3.0, None), (9.0, None)], "x double, y double"
    )
    for frame in (df, df2):
        got = {
            (r["row_name"], r["column_name"]): r["correlation"]
            for r in correlation_matrix(frame).collect()
        }
        assert got["x", "y"] is None and got["y", "x"] is None
        assert got["x", "x"] == 1.0


def test_lower_triangle_and_empty_inputs(spark, table):
    df = spark_table(spark, table)
    pairs = {(r["row_name"], r["column_name"]) for r in correlation_lower(df).collect()}
    assert len(pairs) == 10 and ("b", "a") in pairs and ("a", "a") not in pairs
    assert correlation_matrix(df, ["absent"]).collect() == []
    empty = correlation_matrix(df.limit(0)).collect()
    assert len(empty) == 25 and all(r["correlation"] is None for r in empty)
