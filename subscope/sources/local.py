"""Small frames made on the driver."""

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_frame(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str
) -> DataFrame:
    """A frame of a few rows as a local relation.

    Unlike a parallelised list it takes no task per core, and the optimizer knows its
    exact size when it chooses a join.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(schema.names)
    table = pa.table([pa.array(c) for c in columns], names=schema.names)
    return spark.createDataFrame(table, schema=schema)
