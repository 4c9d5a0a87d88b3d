"""Few large files in place of the many small ones that a stream leaves.

A stream table has one folder per micro-batch (``batch_id=<n>``), which a repeated batch
replaces. Beside it lies a store: folders of compacted ranges of batches, and a manifest of
those that count. A range is written first, to a folder of its own, and counts from the
moment at which its one row is in the manifest, which is a single file. So a reader sees a
range either in the small files or in the large ones, a killed compaction leaves nothing that
is read, and the next one starts at the same place. Small files stay until ``expire``, which
is called when no reader of an older manifest is left.

The newest batch is never compacted: it may run again after a failure. A batch that has a
successor has been committed by the stream.

One job compacts a store at a time. Of rows for the same range, as two jobs would leave
them, readers take the same one, as both hold the same batches.
"""

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.local import local_frame
from .sinks import INTERVAL

BATCH = "batch_id"
ENTRY = "first bigint, last bigint, folder string"


class Entry(NamedTuple):
    """One range of batches, its ends included, and the folder that holds its rows."""

    first: int
    last: int
    folder: str


def write_batches(
    df: DataFrame, path: str, checkpoint: str, interval: str = INTERVAL, available_now: bool = False
) -> StreamingQuery:
    """Write a stream to one folder per micro-batch; a batch that runs again replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def manifest(spark: SparkSession, store: str) -> list[Entry]:
    """The ranges that count, in order; none overlap. One row per compaction is read."""
    try:
        rows = spark.read.schema(ENTRY).parquet(f"{store.rstrip('/')}/manifest").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    chain: list[Entry] = []
    for entry in sorted((Entry(*r) for r in rows), key=lambda e: (e.first, -e.last, e.folder)):
        if not chain or entry.first > chain[-1].last:
            chain.append(entry)
    return chain


def _batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def _after(entries: list[Entry]) -> int:
    return entries[-1].last if entries else -1


def read_table(spark: SparkSession, path: str, store: str, entries: list[Entry] | None = None) -> DataFrame:
    """All rows of the table, by the manifest as it is now or by one read before."""
    entries = manifest(spark, store) if entries is None else entries
    small = _batches(spark, path)
    rest = small.where(F.col(BATCH) > _after(entries)).drop(BATCH)
    if not entries:
        return rest
    folders = [f"{store.rstrip('/')}/ranges/{e.folder}" for e in entries]
    return spark.read.schema(rest.schema).parquet(*folders).unionByName(rest)


def open_batches(spark: SparkSession, path: str, entries: list[Entry]) -> list[int]:
    """Batches beyond the manifest, in order, from the folder names; batches without rows
    have no say."""
    ids = _batches(spark, path).where(F.col(BATCH) > _after(entries)).select(BATCH).distinct()
    return sorted(int(r[BATCH]) for r in ids.collect())


def write_range(spark: SparkSession, path: str, store: str, first: int, last: int) -> Entry:
    """Write the rows of a range to a new folder. It does not count yet. The files have the
    size that adaptive execution aims at (``spark.sql.adaptive.advisoryPartitionSizeInBytes``)."""
    folder = f"{first}-{last}-{uuid.uuid4().hex}"
    rows = _batches(spark, path).where(F.col(BATCH).between(first, last)).drop(BATCH)
    rows.hint("rebalance").write.parquet(f"{store.rstrip('/')}/ranges/{folder}")
    return Entry(first, last, folder)


def commit(spark: SparkSession, store: str, entry: Entry) -> None:
    """Make a range count: one row in one file."""
    frame = local_frame(spark, [tuple(entry)], ENTRY)
    frame.coalesce(1).write.mode("append").parquet(f"{store.rstrip('/')}/manifest")


def compact(spark: SparkSession, path: str, store: str, least: int = 2) -> Entry | None:
    """Compact all settled batches beyond the manifest, if there are at least ``least``."""
    entries = manifest(spark, store)
    settled = open_batches(spark, path, entries)[:-1]
    if len(settled) < max(least, 1):
        return None
    entry = write_range(spark, path, store, _after(entries) + 1, settled[-1])
    commit(spark, store, entry)
    return entry


def expire(spark: SparkSession, path: str, store: str) -> int:
    """Delete the folders of batches that the manifest covers, and those of ranges that it
    does not name; returns how many. Not while a compaction runs or a reader holds an older
    manifest."""
    entries = manifest(spark, store)
    named = {e.folder for e in entries}
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs
    deleted = 0
    for parent, covered in (
        (path, lambda n: n.startswith(f"{BATCH}=") and int(n.split("=")[1]) <= _after(entries)),
        (f"{store.rstrip('/')}/ranges", lambda n: n not in named),
    ):
        folder = hadoop.Path(parent)
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            continue
        for status in system.listStatus(folder):
            if status.isDirectory() and covered(status.getPath().getName()):
                deleted += bool(system.delete(status.getPath(), True))
    return deleted
