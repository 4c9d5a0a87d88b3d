import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subscope.operators.cleaning import SigmaCapModel, SigmaCapper, binarize, clean


def doubles(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def fitted(df, **options):
    return SigmaCapper(**options).fit(df)


def column(df, name="v"):
    return [r[name] for r in df.collect()]


def test_flags_match_lower_case_yes_only(spark):
    df = spark.createDataFrame(
        [(v,) for v in ("yes", "Yes", "YES", "no", None, "")], "churn string"
    )
    out = binarize(df, ["churn"])
    assert column(out, "churn") == [1, 0, 0, 0, 0, 0]
    assert dict(out.dtypes)["churn"] == "int"


def test_missing_values_become_the_mean(spark):
    df = doubles(spark, [1.0, None, 3.0])
    assert column(fitted(df).transform(df)) == [1.0, 2.0, 3.0]


def test_integers_become_doubles(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    out = fitted(df).transform(df)
    assert dict(out.dtypes)["v"] == "double"
    assert column(out) == [1.0, 1.5, 2.0]


def test_nan_counts_as_missing(spark):
    df = doubles(spark, [1.0, math.nan, 3.0])
    assert column(fitted(df).transform(df)) == [1.0, 2.0, 3.0]


def test_infinities_are_capped_not_averaged(spark):
    df = doubles(spark, [1.0, 3.0, math.inf, -math.inf])
    bounds = fitted(df).bounds[0]
    assert bounds.mean == 2.0
    out = column(fitted(df).transform(df))
    assert out[2] == bounds.upper and out[3] == bounds.lower


def test_one_row_is_left_as_it_is(spark):
    df = doubles(spark, [7.0])
    model = fitted(df)
    assert (model.bounds[0].lower, model.bounds[0].upper) == (None, None)
    assert column(model.transform(df)) == [7.0]


def test_empty_and_all_null_tables(spark):
    empty = doubles(spark, [])
    assert column(fitted(empty).transform(empty)) == []
    nulls = doubles(spark, [None, None])
    assert column(fitted(nulls).transform(nulls)) == [None, None]


def test_label_is_left_out_unless_asked_for(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 50, 1).otherwise(0).alias("churn"),
        F.col("id").cast("double").alias("v"),
    )
    assert set(column(fitted(df).transform(df), "churn")) == {0, 1}
    capped = set(column(fitted(df, include_label=True).transform(df), "churn"))
    assert max(capped) == pytest.approx(0.704, abs=1e-3)


def test_one_pass_equals_a_loop_over_columns(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 7 != 0, (F.col("id") * 37 % 101).cast("double")).alias("a"),
        F.when(F.col("id") == 3, 1e6).otherwise(F.col("id") % 5).alias("b"),
    )
    loop = df
    for name in ("a", "b"):
        mean, std = loop.agg(F.avg(name), F.stddev_samp(name)).first()
        low, high = mean - 3 * std, mean + 3 * std
        value = F.coalesce(F.col(name), F.lit(mean))
        loop = loop.withColumn(name, F.greatest(F.least(value, F.lit(high)), F.lit(low)))
    for got, want in zip(fitted(df).transform(df).collect(), loop.collect()):
        assert got["a"] == pytest.approx(want["a"], rel=1e-12)
        assert got["b"] == pytest.approx(want["b"], rel=1e-12)


def test_saved_model_caps_alike(spark, tmp_path):
    df = doubles(spark, [float(i) for i in range(50)] + [1e4, None])
    model = fitted(df)
    model.save(spark, str(tmp_path / "bounds"))
    again = SigmaCapModel.load(spark, str(tmp_path / "bounds"))
    assert again.bounds == model.bounds


def test_model_serves_a_stream(spark, tmp_path):
    df = doubles(spark, [float(i) for i in range(50)] + [1e4])
    model = fitted(df)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (
        model.transform(stream)
        .writeStream.format("memory")
        .queryName("capped")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert max(column(spark.table("capped"))) == model.bounds[0].upper


def test_fit_reads_once_and_stays_in_the_jvm(spark, tmp_path):
    from subscope.operators.profile import column_stats

    from .conftest import plan_of

    df = spark.range(10).selectExpr(*[f"cast(id as double) as c{i}" for i in range(30)])
    df.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t")).select("c1", "c2", "c3")
    text = plan_of(column_stats(table))
    assert text.count("Location: InMemoryFileIndex") == 1
    assert "ReadSchema: struct<c1:double,c2:double,c3:double>" in text
    assert "Python" not in text


def test_cleaning_names_no_missing_column(spark):
    df = doubles(spark, [1.0])
    assert SigmaCapper(columns=["v", "absent"]).fit(df).bounds[0].column == "v"
    _, model = clean(df.withColumn("churn", F.lit("no")), flags=["churn"])
    assert [b.column for b in model.bounds] == ["v"]


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.none() | st.floats(-1e6, 1e6) | st.just(math.nan), min_size=2, max_size=40
    )
)
def test_capped_values_lie_within_the_bounds(spark, values):
    df = doubles(spark, values)
    model = fitted(df)
    b = model.bounds[0]
    for value in column(model.transform(df)):
        if b.mean is None:
            assert value is None or math.isnan(value)
        elif b.upper is not None:
            assert b.lower <= value <= b.upper
