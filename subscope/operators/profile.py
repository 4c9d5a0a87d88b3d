"""Column statistics, label shares and category counts."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    categorical_columns,
    finite,
    name_at,
    not_nan,
    numeric_columns,
    plain,
    safe_ratio,
)
from ..schemas import ID_COLUMNS, LABEL
from ..sources.local import local_frame
from .longform import INDEX, VALUE, long_values


def column_stats(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Mean and sample standard deviation per numeric column, with the row count."""
    names = numeric_columns(df, columns)
    grouped = long_values(df, names, value=finite).groupBy(INDEX)
    stats = grouped.agg(
        F.avg(VALUE).alias("mean"),
        F.stddev_samp(VALUE).alias("std"),
        F.count(F.lit(1)).alias("row_count"),
    )
    return _named(df, stats, names, {"row_count": 0})


def column_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Mean, standard deviation, minimum, maximum and missing values per numeric column.

    NaN counts as missing; infinities stay and show in the figures.
    """
    names = numeric_columns(df, columns)
    grouped = long_values(df, names, value=not_nan).groupBy(INDEX)
    stats = grouped.agg(
        F.avg(VALUE).alias("mean"),
        F.stddev_samp(VALUE).alias("std"),
        F.min(VALUE).alias("min"),
        F.max(VALUE).alias("max"),
        F.count_if(F.col(VALUE).isNull()).alias("null_count"),
    )
    return _named(df, stats, names, {"null_count": 0})


def _named(df: DataFrame, stats: DataFrame, names: list[str], empty: dict[str, int]) -> DataFrame:
    """Statistics by column name, with a row for every column also of an empty table."""
    every = local_frame(df.sparkSession, [(i,) for i in range(len(names))], f"{INDEX} int")
    joined = every.join(stats, INDEX, "left").na.fill(empty)
    figures = [c for c in stats.columns if c != INDEX]
    return joined.select(name_at(names, F.col(INDEX)).alias("column"), *figures)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column of any type, from one pass."""
    names = df.columns if columns is None else [c for c in columns if c in df.columns]
    counted = df.agg(*[F.count_if(plain(c).isNull()).alias(c) for c in names])
    return counted.unpivot([], [plain(c) for c in names], "column", "null_count")


def label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per class."""
    return df.groupBy(plain(label).alias(label)).count()


def label_rate(df: DataFrame, label: str = LABEL, positive: float = 1) -> DataFrame:
    """Row count and percentage of the positive class; NULL for an empty table."""
    hits = F.count_if(plain(label) == positive)
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total_records"),
        (safe_ratio(hits, total) * 100).alias("label_rate"),
    )


def category_by_label(
    df: DataFrame,
    label: str = LABEL,
    columns: Iterable[str] | None = None,
    exclude: Iterable[str] = ID_COLUMNS,
    top: int | None = None,
) -> DataFrame:
    """Rows per category and class of every categorical column.

    ``top`` keeps the most frequent categories of each column with all their classes.
    """
    names = categorical_columns(df, columns, {*exclude, label})
    texts = F.array(*[plain(c).cast("string") for c in names])
    long = df.select(plain(label).alias(label), F.posexplode(texts).alias(INDEX, VALUE))
    if not names:
        long = long.limit(0)
    counted = (
        long.groupBy(INDEX, VALUE, label)
        .count()
        .select(
            name_at(names or [""], F.col(INDEX)).alias("column"),
            F.col(VALUE).cast("string").alias("category"),
            label,
            "count",
        )
    )
    return counted if top is None else _most_frequent(counted, top)


def _most_frequent(counted: DataFrame, top: int) -> DataFrame:
    totals = counted.groupBy("column", "category").agg(F.sum("count").alias("_total"))
    order = Window.partitionBy("column").orderBy(F.desc("_total"), "category")
    kept = totals.withColumn("_rank", F.row_number().over(order)).where(
        F.col("_rank") <= top
    )
    same = counted["column"].eqNullSafe(kept["column"]) & counted[
        "category"
    ].eqNullSafe(kept["category"])
    return counted.join(kept, same, "left_semi")


def report_summary(
    df: DataFrame, label: str = LABEL, exclude: Iterable[str] = ID_COLUMNS
) -> DataFrame:
    """One row: row count, label rate and the names of the profiled columns."""
    return label_rate(df, label).select(
        "total_records",
        "label_rate",
        F.lit(", ".join(numeric_columns(df))).alias("numeric_columns"),
        F.lit(", ".join(categorical_columns(df, None, {*exclude, label}))).alias(
            "categorical_columns"
        ),
    )
