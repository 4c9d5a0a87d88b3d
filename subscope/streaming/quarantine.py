"""Good records to the table, bad ones to a quarantine with what is wrong with them.

Each record is parsed once into typed fields and once into the texts that it gives; a field
that is given but has no typed value has failed. A record that is no JSON object has failed
as a whole, under the name ``RECORD``. So no value is lost silently: what the table leaves
out can be read, mended and sent again.

Defined cases: a NULL record has failed as a whole; a field that is absent or null is no
failure unless it is required; fields beyond the schema are ignored; a record that is there
twice is two records.
"""

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import plain
from ..schemas import EVENT_SCHEMA
from .sinks import INTERVAL

RECORD = "<record>"


def parted(
    df: DataFrame,
    schema: T.StructType = EVENT_SCHEMA,
    value: str = "value",
    position: Sequence[Column] = (),
    required: Sequence[str] = (),
) -> DataFrame:
    """data (typed fields), raw, position (JSON text of the given columns) and failing: the
    names of fields that have failed, none for a good record. A stream or a batch."""
    unknown = set(required) - set(schema.names)
    if unknown:
        raise ValueError(f"required fields are not in the schema: {sorted(unknown)}")
    where = F.to_json(F.struct(*position)) if position else F.lit(None).cast("string")
    read = df.select(plain(value).cast("string").alias("raw"), where.alias("position"))
    read = read.withColumns({"data": F.from_json("raw", schema), "_given": F.from_json("raw", "map<string,string>")})
    checks = []
    for name in schema.names:
        wrong = F.col("data")[name].isNull()
        if name not in required:
            wrong &= F.try_element_at("_given", F.lit(name)).isNotNull()
        checks.append(F.when(wrong, F.lit(name)))
    fields = F.filter(F.array(*checks), lambda x: x.isNotNull())
    failing = F.when(F.col("_given").isNull(), F.array(F.lit(RECORD))).otherwise(fields)
    return read.select("data", "raw", "position", failing.alias("failing"))


def write_batch(
    both: DataFrame, batch_id: int, path: str, quarantine: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df
) -> None:
    """Write one micro-batch of ``parted`` rows to both tables, parsed once. A batch that
    runs again after a failure replaces its own folders."""
    both = both.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bad = F.size("failing") > 0
        good = transform(both.where(~bad).select("data.*"))
        good.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
        rest = both.where(bad).select("raw", "position", "failing")
        rest.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch_id={batch_id}")
    finally:
        both.unpersist()


def write_parted_stream(
    records: DataFrame,
    path: str,
    quarantine: str,
    checkpoint: str,
    schema: T.StructType = EVENT_SCHEMA,
    value: str = "value",
    position: Sequence[Column] = (),
    required: Sequence[str] = (),
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    interval: str = INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Part a stream of encoded records into a table of typed rows, passed through
    ``transform``, and a quarantine; one folder per micro-batch in each."""
    both = parted(records, schema, value, position, required)
    writer = both.writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, path, quarantine, transform))
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All micro-batches of one of the two tables."""
    return spark.read.option("basePath", path).parquet(path).drop("batch_id")
