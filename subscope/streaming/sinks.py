"""Stream sinks."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

INTERVAL = "60 seconds"


def write_parquet_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "append",
    interval: str = INTERVAL,
    available_now: bool = False,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Start writing a stream to Parquet files, exactly once by its checkpoint.

    ``available_now=True`` works off what is there and ends, for backfills.
    """
    if output_mode != "append":
        raise ValueError("the Parquet sink supports the append mode only")
    writer = (
        df.writeStream.outputMode(output_mode)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
