"""Small helpers shared by the operators of this package."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import plain
from ..session import scratch_path

# A task works on so many bytes of text at a time, which bounds its arrays.
PIECE_BYTES = 2 << 20


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_PER_BATCH = 500


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python by so many rows, unless the session says how many.

    Spark's own number suits rows of numbers. Texts are larger, and a batch is in memory
    several times on its way, on both sides.
    """
    if spark.conf.get(BATCH_ROWS, None) is None:
        spark.conf.set(BATCH_ROWS, str(TEXTS_PER_BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; other columns never clash."""
    small_batches(docs.sparkSession)
    return docs.select(
        plain(id_col).cast("long").alias("doc_id"), plain(text_col).cast("string").alias("text")
    )


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in row ranges of about ``limit`` bytes of one string column.

    A single longer value is a range of its own; no value is cut.
    """
    values = batch.column(column)
    sizes = np.asarray(pc.binary_length(values).fill_null(0), dtype=np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if len(sizes) > start:
        yield batch.slice(start)


def by_pieces(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str, column: str = "text"
) -> DataFrame:
    """Apply ``work`` to pieces of each batch; it returns columns by name."""
    fields = [f.name for f in StructType.fromDDL(schema).fields]

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, column):
                out = work(piece)
                columns = [x if isinstance(x, pa.Array) else pa.array(x) for x in map(out.get, fields)]
                yield pa.RecordBatch.from_arrays(columns, names=fields)

    return df.mapInArrow(run, schema)


def runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of each value of ``keys``, which come one after the other, as one table."""
    waiting = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if waiting is not None:
            table = pa.concat_tables([waiting, table]).combine_chunks()
        if not len(table):
            continue
        values = np.stack([table.column(c).to_numpy() for c in keys])
        starts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1).tolist()]
        for a, b in zip(starts[:-1], starts[1:]):
            yield table.slice(a, b - a)
        waiting = table.slice(starts[-1])
    if waiting is not None and len(waiting):
        yield waiting


def gathered(lists: Iterator[list], least: int) -> Iterator[list]:
    """The lists joined until they have ``least`` items."""
    waiting = []
    for more in lists:
        waiting.extend(more)
        if len(waiting) >= least:
            yield waiting
            waiting = []
    if waiting:
        yield waiting


def fresh_names(df: DataFrame, names: list[str]) -> list[str]:
    """The names with underscores in front until no column of the frame has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def appended(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, dict[str, str]]:
    """All columns of the frame and those that ``work`` gives for each row's id and text.

    The second result maps the names of ``schema`` to the names they got, which avoid those
    of the frame. Only id and text go to Python and only the new columns come back; the
    rows wait in the JVM, and nothing has to be joined back.
    """
    small_batches(df.sparkSession)
    wanted = StructType.fromDDL(schema)
    names = fresh_names(df, [f.name for f in wanted.fields])
    found = fresh_names(df, ["found"])[0]

    @F.arrow_udf(wanted)
    def run(ids: pa.Array, texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([ids, texts], names=["doc_id", "text"])
        parts = []
        for piece in list(pieces(batch, "text")) or [batch]:
            out = work(piece)
            columns = [x if isinstance(x, pa.Array) else pa.array(x) for x in (out[f.name] for f in wanted.fields)]
            parts.append(pa.StructArray.from_arrays(columns, names=[f.name for f in wanted.fields]))
        return pa.concat_arrays(parts)

    new = run(plain(id_col).cast("long"), plain(text_col).cast("string"))
    added = [plain(found)[f.name].alias(n) for n, f in zip(names, wanted.fields)]
    return df.withColumn(found, new).select(*map(plain, df.columns), *added), dict(zip([f.name for f in wanted.fields], names))


def checkpointed(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, read back: later steps start from it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def known_labels(labels: DataFrame, label: str, keep=None, values=(0, 1)) -> DataFrame:
    """doc_id, label of the ids with one label; contradictory and missing ones are left out."""
    known = labels.select(plain("doc_id").cast("long").alias("doc_id"), plain(label).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(*values))
    if keep is not None:
        known = known.where(keep)
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    return known.where("label = other").drop("other")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, keep=None, values=(0, 1)
) -> DataFrame:
    """Up to ``rows`` documents with an unambiguous label: doc_id, text, label.

    The rows are the smallest by a hash of the id, so the sample depends neither on the
    layout nor on the order of the tables. Ids with contradictory or missing labels are
    left out, as are missing ids. Of rows that repeat an id one is taken. ``keep`` is an
    optional condition on doc_id. The ids are broadcast: at most ``rows`` pairs of numbers.
    """
    known = known_labels(labels, label, keep, values)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return one_per_id(id_and_text(docs).join(F.broadcast(chosen), "doc_id"), "doc_id", "label")


def one_per_id(texts: DataFrame, *keys: str) -> DataFrame:
    """One row of each value of the keys, the text with the smallest hash; chosen in the
    task that reads the rows, so that repeated ids do not send their texts on."""
    first = texts.groupBy(*keys).agg(F.min(F.struct(F.xxhash64("text").alias("place"), "text")).alias("first"))
    return first.select("doc_id", F.col("first.text").alias("text"), *(k for k in keys if k != "doc_id"))


def crc_remainder(modulus: int, id_col: str = "doc_id"):
    """crc32 of the id written as text, modulo ``modulus``; NULL ids have none."""
    return F.crc32(plain(id_col).cast("string").cast("binary")) % modulus
