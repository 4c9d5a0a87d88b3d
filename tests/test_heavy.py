from collections import Counter

import pytest
from pyspark.sql import functions as F

from subscope.operators.heavy import HASHES, heavy_categories, merged, store_part, stored, summary, width_of


def brute(rows, share):
    """rows: (label, value) of one column."""
    totals, classes = Counter(v for _, v in rows), Counter(rows)
    return {(v, y, n, totals[v]) for (y, v), n in classes.items() if totals[v] >= len(rows) * share}


def result(df):
    return {(r["category"], r["churn"], r["count"], r["total"]) for r in df.collect()}


@pytest.mark.parametrize("share", [0.5, 0.25, 0.2, 0.01])
def test_equals_brute_force_with_nulls_and_ties(spark, share):
    rows = [(i % 2, None) for i in range(50)] + [(1, "hot")] * 100 + [(0, "")] * 4 + [(None, f"v{i}") for i in range(46)]
    df = spark.createDataFrame(rows, "churn int, code string")
    assert result(heavy_categories(df, share)) == brute(rows, share)


def test_nothing_is_lost_among_a_million_values(spark):
    n = 1_000_000
    value = F.when(F.col("id") % 4 == 0, F.concat(F.lit("hot"), F.pmod(F.xxhash64("id"), F.lit(300)))).otherwise(F.concat(F.lit("v"), "id"))
    df = spark.range(n).select((F.col("id") % 2).alias("churn"), value.alias("code"))
    share = 0.0008
    exact = df.groupBy("code").count().where(F.col("count") >= n * share).collect()
    found = heavy_categories(df, share).select("category", "total").distinct().collect()
    assert len(exact) > 100
    assert {tuple(r) for r in found} == {tuple(r) for r in exact}
    # The summary does not grow with the values.
    assert summary(df, ["code"], share).count() <= HASHES * width_of(share)


def test_candidates_are_few(spark):
    """The second pass counts hardly any value below the bound."""
    share = 0.01
    df = spark.range(200_000).select(F.lit(1).alias("churn"), F.concat(F.lit("v"), "id").alias("code"))
    sizes = summary(df, ["code"], share)
    assert sizes.where(F.col("rows") >= 200_000 * share).count() == 0
    assert heavy_categories(df, share, counted=sizes).count() == 0


def test_parts_merge_to_one_pass(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") % 3).alias("churn"), (F.col("id") % 40 * (F.col("id") % 7)).cast("string").alias("code"))
    for part in (0, 0, 1, 2):
        store_part(df.where(F.col("churn") == part), str(tmp_path / "s"), f"p{part}", ["code"], 0.02)
    whole = summary(df, ["code"], 0.02)
    kept = stored(spark, str(tmp_path / "s"))
    assert kept.exceptAll(merged(whole)).count() == 0 == merged(whole).exceptAll(kept).count()
    assert result(heavy_categories(df, 0.02, counted=kept)) == result(heavy_categories(df, 0.02))


def test_empty_table_odd_names_and_no_columns(spark):
    df = spark.createDataFrame([], "`a.b` string, churn int, count long")
    assert heavy_categories(df, 0.1).columns == ["column", "category", "churn", "count", "total"]
    assert heavy_categories(df, 0.1).count() == 0
    one = spark.createDataFrame([("x", 1, 5)], df.schema)
    (row,) = heavy_categories(one, 0.1).collect()
    assert (row["column"], row["category"], row["count"], row["total"]) == ("a.b", "x", 1, 1)
    assert heavy_categories(one.select("churn"), 0.1).count() == 0


@pytest.mark.parametrize("share", [0, -1, 1.5])
def test_shares_outside_are_refused(share):
    with pytest.raises(ValueError):
        width_of(share)


def test_second_pass_shuffles_candidates_only(spark):
    df = spark.range(100).select(F.lit(1).alias("churn"), F.col("id").cast("string").alias("code"))
    plan = heavy_categories(df, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= HASHES and "CartesianProduct" not in plan
