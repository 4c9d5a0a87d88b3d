"""Categories above a share of the rows, for columns with very many distinct values.

A summary counts hash buckets instead of values: for each column a few independent hashes,
each with a number of buckets that follows from the share alone. Its size does not grow with
the distinct values, and summaries of parts are merged by adding them. A category's bucket
holds at least its own rows, so under every hash a category above the bound lies in a bucket
above it: candidates are values all of whose buckets are. Of the buckets of one hash at most
1 / share are above the bound, so the lookups of the second pass have a proven size. That
pass counts the rows of candidates only, exactly, and what is below the bound goes.

Defined cases: NULL is a category; a category with exactly the share is kept; an empty table
gives no rows; columns without text are read as text.
"""

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import categorical_columns, name_at, plain
from ..schemas import ID_COLUMNS, LABEL
from ..session import scratch_path
from .longform import INDEX, VALUE

HASHES = 3
# Buckets per hash and category that can be above the bound; more leave fewer candidates.
ROOM = 8
# Most buckets that the second pass looks up.
MAX_BUCKETS = 3_000_000

SUMMARY = "column string, hash int, bucket bigint, rows bigint"


def width_of(share: float) -> int:
    """Buckets of one hash, a power of two."""
    if not 0 < share <= 1:
        raise ValueError("the share lies above 0 and is at most 1")
    return 2 ** math.ceil(math.log2(ROOM / share))


def _buckets(width: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), F.col(VALUE)), F.lit(width)) for i in range(HASHES)]


def _long(df: DataFrame, names: Sequence[str], *others: Column) -> DataFrame:
    texts = F.array(*[plain(c).cast("string") for c in names])
    return df.select(*others, F.posexplode(texts).alias(INDEX, VALUE))


def summary(df: DataFrame, columns: Sequence[str], share: float) -> DataFrame:
    """Rows per column, hash and bucket: at most ``HASHES * width_of(share)`` a column.
    Counted within the scan tasks before anything is shuffled."""
    names = list(columns)
    keyed = _long(df, names).select(INDEX, F.posexplode(F.array(*_buckets(width_of(share)))).alias("hash", "bucket"))
    counted = keyed.groupBy(INDEX, "hash", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(name_at(names, F.col(INDEX)).alias("column"), "hash", "bucket", "rows")


def store_part(df: DataFrame, path: str, part: str, columns: Sequence[str], share: float) -> None:
    """Write the summary of one ingestion part; a part that comes again replaces its own."""
    summary(df, columns, share).write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={part}")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The stored summaries of all parts, merged."""
    return merged(spark.read.schema(f"{SUMMARY}, part string").parquet(path))


def merged(summaries: DataFrame) -> DataFrame:
    return summaries.groupBy("column", "hash", "bucket").agg(F.sum("rows").alias("rows"))


def heavy_categories(
    df: DataFrame,
    share: float,
    columns: Iterable[str] | None = None,
    label: str = LABEL,
    exclude: Iterable[str] = ID_COLUMNS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """column, category, label, count (of the class) and total of every category that holds
    at least ``share`` of the rows.

    ``counted`` is a summary made before with the same share, of all of ``df``; without it,
    one is made in a pass of its own and kept in the shared folder for the second pass.
    """
    names = categorical_columns(df, columns, {*exclude, label})
    width = width_of(share)
    if HASHES * len(names) / share > MAX_BUCKETS:
        raise ValueError(f"a share of {share} of {len(names)} columns needs more than {MAX_BUCKETS} buckets")
    spark = df.sparkSession
    counted = summary(df, names or [label], share) if counted is None else merged(counted)
    path = scratch_path(spark, "heavy")
    counted.write.parquet(path)
    counted = spark.read.schema(SUMMARY).parquet(path)

    places = F.create_map(*[F.lit(x) for i, c in enumerate(names) for x in (c, i)]) if names else F.create_map()
    known = counted.select(F.try_element_at(places, F.col("column")).cast("int").alias(INDEX), "hash", "bucket", "rows")
    sizes = known.where("hash = 0").groupBy(INDEX).agg(F.sum("rows").alias("_all"))
    # One row per column.
    above = known.join(F.broadcast(sizes), INDEX).where(F.col("rows") >= F.col("_all") * share)

    long = _long(df, names, plain(label).alias(label))
    if not names:
        long = long.limit(0)
    for i, bucket in enumerate(_buckets(width)):
        # At most 1 / share rows a column, see above.
        found = F.broadcast(above.where(F.col("hash") == i).select(INDEX, F.col("bucket").alias("_bucket")))
        long = long.withColumn("_bucket", bucket).join(found, [INDEX, "_bucket"], "left_semi").drop("_bucket")
    classes = long.groupBy(INDEX, VALUE, label).agg(F.count(F.lit(1)).alias("count"))
    totals = classes.groupBy(INDEX, VALUE).agg(F.sum("count").alias("total"))
    kept = totals.join(F.broadcast(sizes), INDEX).where(F.col("total") >= F.col("_all") * share)
    kept = kept.select(F.col(INDEX).alias("_i"), F.col(VALUE).alias("_v"), "total")
    same = (F.col(INDEX) == F.col("_i")) & F.col(VALUE).eqNullSafe(F.col("_v"))
    named = name_at(names or [""], F.col(INDEX)).alias("column")
    return classes.join(kept, same).select(named, F.col(VALUE).cast("string").alias("category"), label, "count", "total")
