"""Model scores for streamed events.

An event carries no model feature, only its customer. Scores are therefore computed once
per customer by a batch job that writes them, and the stream looks them up in that table.
"""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import plain
from ..operators.modeling import probability_of, score
from ..schemas import ID
from .sinks import INTERVAL


def customer_scores(model: PipelineModel, features: DataFrame, key: str = ID) -> DataFrame:
    """Customer, predicted class and probability of class 1, one row per input row.

    A row that lacks a feature is there with ``complete`` false and no prediction.
    """
    return score(model, features).select(
        plain(key).alias(key), "prediction", probability_of().alias("probability"), "complete"
    )


def unique_scores(scores: DataFrame, key: str = ID) -> DataFrame:
    """One row per customer that is known by a key: the one with the highest probability,
    without one only where no row of the customer has any."""
    best = F.max(F.struct("complete", "probability", "prediction")).alias("best")
    known = scores.where(plain(key).isNotNull()).groupBy(plain(key).alias(key)).agg(best)
    names = ("prediction", "probability", "complete")
    return known.select(plain(key), *(F.col("best")[n].alias(n) for n in names))


SPREAD = 1024  # partitions' worth of salt for events without a customer


def attach_scores(events: DataFrame, scores: DataFrame, key: str = ID) -> DataFrame:
    """Events with the score of their customer, NULL for an unknown one.

    ``scores`` has one row per customer, so the number of events stays. Events without a
    customer match nothing and are spread by a hash of the row, as one hash of NULL would
    bring them all to one task.
    """
    salt = F.pmod(F.xxhash64(*map(plain, events.columns)), F.lit(SPREAD))
    salted = events.withColumn("_salt", F.when(plain(key).isNull(), salt).otherwise(0))
    right = scores.withColumn("_salt", F.lit(0).cast("long"))
    return salted.join(right, [key, "_salt"], "left").drop("_salt")


def write_scored_stream(
    events: DataFrame,
    scores_path: str,
    path: str,
    checkpoint: str,
    key: str = ID,
    interval: str = INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Write events with scores, one folder per micro-batch.

    The scores are a written table with one row per customer, read by each micro-batch:
    nothing is scored again. Each micro-batch is joined as a batch, so adaptive execution picks the join by the
    real sizes and splits the partition of a customer with very many events. A batch
    that runs again after a failure replaces its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path.rstrip('/')}/batch_id={batch_id}"
        scores = batch.sparkSession.read.parquet(scores_path)
        attach_scores(batch, scores, key).write.mode("overwrite").parquet(target)

    writer = events.writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
