"""CSV and Parquet tables."""

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import RAW_SCHEMA


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA
) -> DataFrame:
    """CSV with a header line and a fixed schema, without an inference pass.

    Columns bind by position, whatever the header says; a field that does not parse
    becomes NULL.
    """
    return spark.read.schema(schema).csv(path, header=True, mode="PERMISSIVE")


def read_parquet(spark: SparkSession, path: str, cache: bool = False) -> DataFrame:
    """Parquet with the schema of its files.

    ``cache=True`` keeps the frame for repeated use; blocks that do not fit in memory
    go to disk and lost blocks are read again from the table.
    """
    df = spark.read.parquet(path)
    return df.persist(StorageLevel.MEMORY_AND_DISK) if cache else df


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The frame over so many partitions, or as its scan has it where none are asked for.

    A file of one row group is read by a single task; whoever knows that says so here.
    """
    return df if partitions is None else df.repartition(partitions)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows in no particular order."""
    return df.limit(rows)
