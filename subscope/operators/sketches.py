"""Stored quantile sketches of ingestion parts, merged instead of read again.

A part of the data leaves one row per class and numeric column: the number of values, the
exact extremes and a KLL sketch of fixed size. Sketches merge in any order and grouping, so
quartiles, boxes and histograms of all data are renewed by reading the new part alone and a
small table of the others. Sketches are built and merged by Spark's own aggregates, partially
in the scan task, so a class that holds most rows costs nothing extra.

A quantile of a merged sketch has a rank within ``rank_error`` of the asked one, with the
confidence of the sketch (99 %); extremes and counts are exact. NULL, NaN and infinities do
not enter. A class without a value in a column has no row for it.
"""

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import name_at, numeric_columns, plain
from ..schemas import LABEL
from .longform import GROUP, INDEX, VALUE, long_values

K = 1024  # size of a sketch; its rank error falls with nearly the first power of it
STEPS = 500  # ranks at which histograms and outliers look into a sketch, half a step more of error


def rank_error(k: int = K) -> float:
    """The published bound of the rank error of one query of a sketch of that size."""
    return 2.296 / k**0.9021


def part_sketches(df: DataFrame, columns: Iterable[str] | None = None, label: str = LABEL, k: int = K) -> DataFrame:
    """label, column, n, low, high and sketch of each class and column."""
    names = numeric_columns(df, columns, {label})
    values = long_values(df, names, label).where(F.col(VALUE).isNotNull())
    grouped = values.groupBy(GROUP, INDEX).agg(
        F.count(VALUE).alias("n"), F.min(VALUE).alias("low"), F.max(VALUE).alias("high"), F.kll_sketch_agg_double(VALUE, k).alias("sketch")
    )
    return grouped.select(F.col(GROUP).alias(label), name_at(names, F.col(INDEX)).alias("column"), "n", "low", "high", "sketch")


def merged(sketches: DataFrame, label: str | None = LABEL, k: int = K) -> DataFrame:
    """One row per class and column from those of any parts; per column without a label."""
    keys = ["column"] if label is None else [label, "column"]
    return sketches.groupBy(*map(plain, keys)).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch", k).alias("sketch")
    )


def store_part(df: DataFrame, path: str, part: str, columns: Iterable[str] | None = None, label: str = LABEL, k: int = K) -> None:
    """Write the sketches of one part. A part that is written again replaces itself."""
    target = f"{path.rstrip('/')}/part={part}"
    part_sketches(df, columns, label, k).coalesce(1).write.mode("overwrite").parquet(target)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The sketches of all parts, with the part's name as text."""
    found = spark.read.option("basePath", path).parquet(path)
    return found.withColumn("part", F.col("part").cast("string"))


def _quantile(probability: float) -> Column:
    if probability <= 0:
        return F.col("low")
    if probability >= 1:
        return F.col("high")
    return F.kll_sketch_get_quantile_double("sketch", F.lit(float(probability)))


def quantiles(sketches: DataFrame, probabilities: Sequence[float], label: str = LABEL) -> DataFrame:
    """label, column, n, probability, value; the extremes are exact."""
    asked = F.array(*(F.struct(F.lit(float(p)).alias("probability"), _quantile(p).alias("value")) for p in probabilities))
    rows = sketches.select(plain(label), "column", "n", F.explode(asked).alias("q"))
    return rows.select(plain(label), "column", "n", "q.probability", "q.value")


def _with_steps(sketches: DataFrame) -> DataFrame:
    """The values in the middle of STEPS equal shares of the ranks, as ``_steps``: Spark
    gives ranks of literal values only, and these give the rank of any value."""
    middles = F.array(*(F.lit((i + 0.5) / STEPS) for i in range(STEPS)))
    return sketches.withColumn("_steps", F.kll_sketch_get_quantile_double("sketch", middles))


def _share(wanted: Callable[[Column], Column], none: Column, all_: Column) -> Column:
    """About the share of the values that are wanted, known to be none or all of them by
    the extremes."""
    inner = F.size(F.filter("_steps", wanted)) / float(STEPS)
    return F.when(none, 0.0).when(all_, 1.0).otherwise(inner)


def _share_below(point: Column) -> Column:
    return _share(lambda v: v < point, point <= F.col("low"), point > F.col("high"))


def _share_above(point: Column) -> Column:
    return _share(lambda v: v > point, point >= F.col("high"), point < F.col("low"))


def boxes(sketches: DataFrame, label: str = LABEL) -> DataFrame:
    """label, column, count, quartiles, fences at 1.5 interquartile ranges, about how many
    values lie outside, and the exact extremes."""
    quartiles = sketches.withColumns({"q1": _quantile(0.25), "median": _quantile(0.5), "q3": _quantile(0.75)})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fenced = quartiles.withColumns({"fence_low": F.col("q1") - reach, "fence_high": F.col("q3") + reach})
    outside = F.round(F.col("n") * (_share_below(F.col("fence_low")) + _share_above(F.col("fence_high")))).cast("long")
    return _with_steps(fenced).select(
        plain(label), "column", F.col("n").alias("count"), "q1", "median", "q3", "fence_low", "fence_high", outside.alias("outliers_about"), "low", "high"
    )


def histogram(sketches: DataFrame, bins: int = 30, label: str = LABEL) -> DataFrame:
    """label, column, bin, left, right and about how many values lie in [left, right).

    Edges are shared by the classes of a column; the last bin holds its right end. The counts
    of a class add up to its values, each within twice the rank error.
    """
    if bins < 1:
        raise ValueError("a histogram has at least one bin")
    column = W.partitionBy("column")
    spans = sketches.withColumns({"_lo": F.min("low").over(column), "_hi": F.max("high").over(column)})
    width = (F.col("_hi") - F.col("_lo")) / bins
    rows = _with_steps(spans).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    rows = rows.withColumns({"left": F.col("_lo") + F.col("bin") * width, "right": F.col("_lo") + (F.col("bin") + 1) * width})
    last = F.col("bin") == bins - 1
    below = F.when(F.col("bin") == 0, 0.0).otherwise(_share_below(F.col("left")))
    to = F.when(last, 1.0).otherwise(_share_below(F.col("right")))
    # Differences of rounded totals add up to the number of values.
    count = (F.round(F.col("n") * to) - F.round(F.col("n") * below)).cast("long")
    right = F.when(last, F.col("_hi")).otherwise(F.col("right"))
    return rows.select(plain(label), "column", "bin", "left", right.alias("right"), count.alias("count_about"))
