"""Data profile: the tables behind a report, each of them small."""

import math
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric_columns
from ..operators.correlation import correlation_lower
from ..operators.distribution import (
    DENSITY_RESOLUTION,
    box_stats_by_label,
    density_by_label,
    histogram_by_label,
)
from ..operators.profile import (
    category_by_label,
    column_profile,
    label_distribution,
    report_summary,
)
from ..operators.quantiles import class_bins, class_summary
from ..schemas import LABEL
from ..sources.tables import read_parquet, write_parquet

# Rows of kept bins per partition.
BIN_ROWS = 25_000


def report_tables(
    df: DataFrame,
    label: str = LABEL,
    resolution: int | None = DENSITY_RESOLUTION,
    box_method: str = "exact",
    columns: Iterable[str] | None = None,
    categories: Iterable[str] | None = None,
    bins: int | str = "auto",
) -> dict[str, DataFrame]:
    """The report as one frame per table.

    ``columns`` and ``categories`` choose what the distribution, correlation and category
    tables show. Densities use ``resolution`` bins instead of all distinct values, which
    the table states in its column ``resolution``; None is exact.
    """
    return _report(df, label, resolution, box_method, columns, categories, bins)[0]


def _report(
    df: DataFrame,
    label: str = LABEL,
    resolution: int | None = DENSITY_RESOLUTION,
    box_method: str = "exact",
    columns: Iterable[str] | None = None,
    categories: Iterable[str] | None = None,
    bins: int | str = "auto",
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The report, and the bins that its tables share, which are kept."""
    columns = None if columns is None else list(columns)
    names = numeric_columns(df, columns, {label})
    summary = class_summary(df, names, label)
    # At most so many rows per class and column, whatever the table's size. The partitions of
    # kept frames are not adapted to their size.
    number = resolution or DENSITY_RESOLUTION
    binned = class_bins(df, names, label, summary, number)
    binned = binned.coalesce(math.ceil(max(1, len(summary) * number) / BIN_ROWS)).persist()
    tables = {
        "summary": report_summary(df, label),
        "column_profile": column_profile(df),
        "label_distribution": label_distribution(df, label),
        "category_by_label": category_by_label(df, label, categories),
        "histogram_by_label": histogram_by_label(
            df, label, columns, bins, summary=summary, binned=binned
        ),
        "density_by_label": density_by_label(
            df, label, columns, resolution=resolution, summary=summary, binned=binned
        ).withColumn("resolution", F.lit(resolution).cast("int")),
        "box_stats_by_label": box_stats_by_label(
            df, label, columns, method=box_method, summary=summary, binned=binned
        ),
        "correlation_lower": correlation_lower(df, columns),
    }
    return tables, binned


def run_profile(
    spark: SparkSession,
    data_path: str,
    output_path: str,
    cache: bool = False,
    label: str = LABEL,
    **options: Any,
) -> dict[str, Any]:
    """Write the report's tables below ``output_path``.

    Each pass reads only the columns it needs. ``cache=True`` pays where the table fits
    into the cluster's memory. ``options`` are those of :func:`report_tables`.
    """
    df, binned = read_parquet(spark, data_path, cache=cache), None
    try:
        tables, binned = _report(df, label, **options)
        for name, table in tables.items():
            write_parquet(table, f"{output_path.rstrip('/')}/{name}")
    finally:
        if binned is not None:
            binned.unpersist()
        if cache:
            df.unpersist()
    summary = read_parquet(spark, f"{output_path.rstrip('/')}/summary").first()
    return summary.asDict()
