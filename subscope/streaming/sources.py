"""Stream sources. Each gives a frame with the encoded record in ``value``."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source for one topic.

    ``max_offsets_per_trigger`` bounds a micro-batch after a long stop;
    ``min_partitions`` splits topic partitions that hold most of the records.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream of Kafka records; needs Spark's Kafka connector on the class path."""
    try:
        return spark.readStream.format("kafka").options(**options).load()
    except AnalysisException as error:
        raise RuntimeError(
            "the Kafka source is not available: add the spark-sql-kafka-0-10 package "
            "of this Spark version"
        ) from error


def read_text_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of text files, one record per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_record_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of Parquet files holding binary records, as archived from a topic."""
    reader = spark.readStream.format("parquet").schema("value binary")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
