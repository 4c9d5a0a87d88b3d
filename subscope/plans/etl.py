"""Batch ETL: CSV in, cleaned features as Parquet out."""

from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import SigmaCapModel, SigmaCapper, binarize
from ..operators.features import add_features
from ..sources.tables import read_csv, read_parquet, spread, write_parquet


def process(
    raw: DataFrame, include_label: bool = False, partitions: int | None = None
) -> tuple[DataFrame, SigmaCapModel]:
    """Cleaned table with features, and the fitted bounds.

    ``partitions`` deals the rows of the result out anew, for an input that is known to
    be read by too few tasks.
    """
    model = SigmaCapper(include_label=include_label).fit(binarize(raw))
    return add_features(model.transform(binarize(spread(raw, partitions)))), model


def run_etl(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    bounds_path: str | None = None,
    stage_path: str | None = None,
    include_label: bool = False,
    partitions: int | None = None,
) -> dict[str, Any]:
    """Read, clean, derive and write; returns the figures of the run.

    The input is read twice, for the statistics and for the result. With ``stage_path``
    it is first copied there as Parquet: the text is parsed once, and the statistics
    read only the numeric columns. The copy is the caller's to keep or remove.
    """
    raw = read_csv(spark, input_path)
    if stage_path:
        write_parquet(raw, stage_path)
        raw = read_parquet(spark, stage_path)
    return write_processed(spark, raw, output_path, bounds_path, include_label, partitions)


def write_processed(
    spark: SparkSession,
    raw: DataFrame,
    output_path: str,
    bounds_path: str | None = None,
    include_label: bool = False,
    partitions: int | None = None,
) -> dict[str, Any]:
    """The part of the job after the scan."""
    processed, model = process(raw, include_label, partitions)
    # The figures come from the writing job itself, without another pass.
    seen = Observation()
    observed = processed.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("daytime_ratio").isNull()).alias("rows_without_minutes"),
    )
    write_parquet(observed, output_path)
    if bounds_path:
        model.save(spark, bounds_path)
    return dict(seen.get)
