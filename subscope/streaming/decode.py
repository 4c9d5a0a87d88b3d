"""From encoded records to typed events. Works on streams and on batches alike."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import plain
from ..schemas import EVENT_SCHEMA


def decode_json(
    df: DataFrame,
    schema: T.StructType = EVENT_SCHEMA,
    value: str = "value",
    on_malformed: str = "keep",
) -> DataFrame:
    """Parse JSON in a text or binary column into the fields of ``schema``.

    A record that is no JSON object gives a row of NULLs; a field of the wrong type is
    NULL on its own. ``on_malformed="drop"`` leaves out rows without any field.
    """
    if on_malformed not in ("keep", "drop"):
        raise ValueError("on_malformed is 'keep' or 'drop'")
    text = plain(value).cast("string")
    decoded = df.select(F.from_json(text, schema).alias("data")).select("data.*")
    if on_malformed == "keep":
        return decoded
    present = [plain(f.name).isNotNull() for f in schema.fields]
    return decoded.where(reduce(lambda a, b: a | b, present))


def enrich(df: DataFrame) -> DataFrame:
    """Add the event time as ``processing_time`` and the roaming flag as 0/1/NULL."""
    return df.withColumns(
        {
            "processing_time": F.col("timestamp"),
            "is_roaming": (F.col("roaming") == 1).cast("int"),
        }
    )
