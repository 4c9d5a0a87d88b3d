"""Scores for streamed events from a state per customer.

Score changes are a stream of their own. The state store keeps the latest score of each
customer, so a micro-batch touches the customers it has rows of, and no table of all scores
is read. The state is part of the query's checkpoint: after a restart it is as it was at
the last finished micro-batch.

A change counts by its own order, a number or time at which it was made. One that is older
than what the state holds, or equal to it, changes nothing, so late and repeated changes do
no harm; of two different changes of the same order the one with the higher probability,
and then prediction, stays, in whatever order they come. A change without prediction takes
the score away. All changes of a micro-batch apply before its events.

A state is that of a bucket of customers by the hash of their key, as each look into a
state is a message between Python and Spark: with very many customers in a micro-batch, one
per customer takes far longer than their rows. A micro-batch reads and writes the buckets it
has rows of. The number of buckets is part of a checkpoint: it cannot change later. Before
that, each task packs the latest changes of a bucket into one row.

Events without a customer get no score and are spread over buckets. Changes without a
customer or an order are left out. The events of one bucket in one micro-batch wait in
memory until its changes have been seen; the source's limit per micro-batch bounds them.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import StructType

from ..functions import plain
from ..schemas import ID
from .sinks import write_parquet_stream

# Changes as they are kept: the order as a number.
CHANGE = "change_order long, prediction double, probability double"
SCORE = ("prediction", "probability")
# The customers of a bucket and their changes, in the same order.
BUCKET = "customer array<string>, change_order array<bigint>, prediction array<double>, probability array<double>"
PACKED = [c.split()[0] for c in BUCKET.split(", ")]
BUCKETS = 1 << 13
PACK_ROWS = 1 << 19  # changes of a task that are packed together
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _rank(change: tuple) -> tuple:
    """What makes a change the later one; no prediction is below any."""
    order, prediction, probability = change
    return order, probability is not None, probability or 0.0, prediction is not None, prediction or 0.0


class LatestScore(StatefulProcessor):
    """Keeps the latest change of each customer of a bucket and gives its score to the
    customer's events."""

    def init(self, handle) -> None:
        self.latest = handle.getValueState("latest", BUCKET)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.latest.get()
        held = {} if stored is None else {c: change for c, *change in zip(*stored)}
        changed, waiting = False, []
        for row in rows:
            if row["event"] is not None:
                waiting.append((row["_key"], row["event"]))
                continue
            for customer, *change in zip(*(row[c] for c in PACKED)):
                known = held.get(customer)
                if known is None or _rank(change) > _rank(known):
                    held[customer], changed = change, True
        if changed:
            self.latest.update((list(held), *map(list, zip(*held.values()))))
        for customer, event in waiting:
            _, prediction, probability = held.get(customer, (None, None, None))
            yield Row(**event, prediction=prediction, probability=probability)

    def close(self) -> None:
        pass


def changes_from(df: DataFrame, order: str, key: str = ID, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """Score changes under fixed names; a time as their order counts in microseconds."""
    is_time = dict(df.dtypes)[order] == "timestamp"
    made = F.unix_micros(plain(order)) if is_time else plain(order).cast("long")
    out = df.select(
        plain(key).alias(key), made.alias("change_order"), plain(prediction).cast("double").alias("prediction"), plain(probability).cast("double").alias("probability")
    )
    return out.where(plain(key).isNotNull() & F.col("change_order").isNotNull())


def with_latest_scores(events: DataFrame, changes: DataFrame, key: str = ID) -> DataFrame:
    """A stream of events with prediction and probability of their customer, NULL where it
    has none. ``changes`` is as :func:`changes_from` gives it."""
    spark = events.sparkSession
    if spark.conf.get(PROVIDER, None) != ROCKSDB:
        raise ValueError(f"keyed state needs {PROVIDER}={ROCKSDB}")
    taken = {c.lower() for c in events.columns} & set(SCORE)
    if taken:
        raise ValueError(f"events already have {sorted(taken)}")
    event = F.struct(*map(plain, events.columns)).alias("event")
    no_event = F.lit(None).cast(events.select(event).schema["event"].dataType).alias("event")
    text = plain(key).cast("string")
    no_change = [F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(BUCKET)]
    left = events.select(_bucket(F.when(text.isNotNull(), F.xxhash64(text)).otherwise(F.xxhash64(event))), text.alias("_key"), event, *no_change)
    own = changes.select(_bucket(F.xxhash64(text)), text.alias("customer"), *StructType.fromDDL(CHANGE).names)
    right = own.mapInArrow(_packed, f"_bucket int, {BUCKET}").select("_bucket", F.lit(None).cast("string").alias("_key"), no_event, *PACKED)
    schema = StructType(events.schema.fields)
    for name in SCORE:
        schema = schema.add(name, "double")
    both = left.unionByName(right).groupBy("_bucket")
    return both.transformWithState(LatestScore(), outputStructType=schema, outputMode="Append", timeMode="None")


def _bucket(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(BUCKETS)).cast("int").alias("_bucket")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The latest change of each customer, one row per bucket, of so many rows at a time."""
    waiting, rows = [], 0
    for batch in batches:
        waiting.append(batch)
        rows += len(batch)
        if rows >= PACK_ROWS:
            yield _latest(pa.Table.from_batches(waiting))
            waiting, rows = [], 0
    if rows:
        yield _latest(pa.Table.from_batches(waiting))


def _latest(table: pa.Table) -> pa.RecordBatch:
    # In the order of _rank: what is missing comes first.
    by = ("_bucket", "customer", "change_order", "probability", "prediction")
    places = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in by], null_placement="at_start")
    table = table.take(places).combine_chunks()
    customer = table.column("customer").combine_chunks()
    last = np.ones(len(table), dtype=bool)
    last[:-1] = pc.not_equal(customer[1:], customer[:-1]).to_numpy(zero_copy_only=False)
    table = table.filter(pa.array(last)).combine_chunks()
    bucket = table.column("_bucket").to_numpy()
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    offsets = pa.array(np.append(first, len(bucket)).astype(np.int32))
    names = PACKED
    lists = [pa.ListArray.from_arrays(offsets, table.column(c).combine_chunks()) for c in names]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *lists], names=["_bucket", *names])


def write_keyed_stream(
    events: DataFrame, changes: DataFrame, path: str, checkpoint: str, key: str = ID, available_now: bool = False
) -> StreamingQuery:
    """Write events with the latest scores, exactly once."""
    return write_parquet_stream(with_latest_scores(events, changes, key), path, checkpoint, available_now=available_now)


def kept_scores(spark, checkpoint: str) -> DataFrame:
    """The state of a stopped query: customer and its latest change."""
    state = spark.read.format("statestore").option("stateVarName", "latest").load(checkpoint)
    kept = state.select(F.inline(F.arrays_zip(*(F.col(f"value.{c}") for c in PACKED))))
    return kept.withColumnRenamed("customer", ID)
