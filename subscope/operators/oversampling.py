"""New rows for a rare class: between a row and one of its nearest neighbours.

Neighbours are looked for in a forest of random projections. In each tree all rows of the
class are parted again and again at the median of a random direction, until a leaf has a
bounded number of rows, whatever the data: equal rows are told apart by a hash. A leaf's
rows are compared with each other, and the nearest ones over all trees are a row's
neighbours. The work grows with the rows, and no bucket is hot. A point goes once to its group
in each tree; a few trees are done at a time, and what they have found is written before the
next ones, so that local disks hold the points of these trees only.

Where on the way to which neighbour a new row lies follows from a hash of the row, so that
work done again gives the same rows.
"""

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import plain
from ..schemas import FEATURES, ID, LABEL
from ..session import scratch_path
from .modeling import is_complete

NEIGHBOURS = 5
TREES = 16
TREES_AT_ONCE = 4
LEAF_ROWS = 512
GROUP_LEAVES = 64  # leaves' worth of rows that one task parts by itself
SEED = 42
HASH_STEPS = 1 << 30


# Shuffle files of a write go when it ends, not when the driver happens to collect garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, name: str) -> DataFrame:
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANED) if before is None else spark.conf.set(CLEANED, before)
    return spark.read.schema(df.schema).parquet(path)


def _dropped(df: DataFrame) -> None:
    """Delete the files of a working table that :func:`_written` has made."""
    spark = df.sparkSession
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def standard_rows(df: DataFrame, features: Sequence[str] = FEATURES, key: str = ID) -> DataFrame:
    """row, key, values and point of the rows that have all features: the values as they
    are, and scaled to deviations so that no feature outweighs the others."""
    rows = df.where(is_complete(features))
    values = F.array(*(plain(c).cast("double") for c in features))
    # The numbers of rows are fixed by writing them.
    rows = _written(rows.select(F.monotonically_increasing_id().alias("row"), plain(key).alias("key"), values.alias("values")), "rare-rows")
    spread = rows.agg(*(F.stddev(F.col("values")[i]) for i in range(len(features)))).first()
    scale = [1 / s if s else 0.0 for s in spread]
    return rows.withColumn("point", F.zip_with("values", F.lit(scale), lambda v, s: v * s))


def _places(x: np.ndarray, row: np.ndarray, directions: np.ndarray, tree: np.ndarray, level: int) -> np.ndarray:
    """Where each row lies along the direction of each of the trees at that level."""
    mixed = row.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + (tree.astype(np.uint64) << np.uint64(32)) + np.uint64(level + 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    # A hash far below any difference that matters parts rows at the same place.
    apart = ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(HASH_STEPS)).astype(np.float64) * 1e-18
    return np.einsum("nd,td->nt", x, directions[tree, level]) + apart


def _points_of(batch: pa.RecordBatch | pa.Table, dimensions: int) -> np.ndarray:
    column = batch.column("point")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(batch), dimensions)


def _grouped(points: DataFrame, dimensions: int, trees: int, leaf_rows: int, seed: int, at_once: int | None = None) -> tuple[list[DataFrame], Callable]:
    """tree, node, row, point: the rows in groups of a bounded number, a table for so many trees
    at once, and a function that gives the leaf of each row of a group.

    A row's way down follows from its point and the medians above it, so nothing is written
    on the way: a pass gives the medians of one level, and one number per group reaches the
    driver. Groups are parted further where they are, as a whole.
    """
    total = points.count()
    levels = max(0, int(np.ceil(np.log2(max(total, 1) / leaf_rows))))
    upper = max(0, min(levels, int(np.ceil(np.log2(max(total, 1) / (leaf_rows * GROUP_LEAVES))))))
    directions = np.random.default_rng(seed).normal(size=(trees, levels, dimensions))
    every = np.arange(trees)
    medians: list[np.ndarray] = []

    def nodes_of(x, row, own):
        node = np.zeros((len(row), len(own)), dtype=np.int64)
        for level, middle in enumerate(medians):
            node = node * 2 + (_places(x, row, directions, own, level) > middle[own, node])
        return node

    def places(batches):
        for batch in batches:
            x, row = _points_of(batch, dimensions), batch.column("row").to_numpy()
            at = _places(x, row, directions, every, len(medians))
            tree = np.tile(every.astype(np.int32), len(row))
            yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(nodes_of(x, row, every).ravel()), pa.array(at.ravel())], names=["tree", "node", "place"])

    def placed(first, last):
        def of(batches):
            for batch in batches:
                x, row = _points_of(batch, dimensions), batch.column("row").to_numpy()
                ends = pa.array(np.arange(len(row) + 1, dtype=np.int32) * (last - first))
                nodes = pa.ListArray.from_arrays(ends, pa.array(nodes_of(x, row, every[first:last]).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("point"), nodes], names=["row", "point", "nodes"])

        return of

    narrow = points.select("row", "point")
    for level in range(upper):
        found = narrow.mapInArrow(places, "tree int, node long, place double").groupBy("tree", "node")
        middle = np.full((trees, 1 << level), np.inf)
        for r in found.agg(F.percentile_approx("place", 0.5, 2000).alias("middle")).collect():
            middle[r["tree"], r["node"]] = r["middle"]
        medians.append(middle)
    tables, at_once = [], at_once or trees
    for first in range(0, trees, at_once):
        table = narrow.mapInArrow(placed(first, min(first + at_once, trees)), "row long, point array<double>, nodes array<long>")
        table = table.select("row", "point", F.posexplode("nodes").alias("place", "node"))
        tables.append(table.select((F.col("place") + first).alias("tree"), "node", "row", "point"))

    def leaf(x, row, tree):
        node = np.zeros(len(row), dtype=np.int64)
        for level in range(upper, levels):
            place = _places(x, row, directions, np.array([tree]), level)[:, 0]
            order = np.lexsort((place, node))
            sizes = np.bincount(node)
            within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            node[order] = node[order] * 2 + (within >= np.repeat((sizes + 1) // 2, sizes))
        return node

    return tables, lambda x, row, tree, node: (np.int64(node) << (levels - upper)) + leaf(x, row, tree)


def _group(table: pa.Table, dimensions: int, leaf_of: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Rows of a group in their order, with points, leaves and tree."""
    row = table.column("row").to_numpy()
    order = np.argsort(row)
    row, x = row[order], _points_of(table, dimensions)[order]
    tree = table.column("tree")[0].as_py()
    return row, x, leaf_of(x, row, tree, table.column("node")[0].as_py()), tree


def leaves(points: DataFrame, dimensions: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = SEED) -> DataFrame:
    """row, tree, node: the leaf of each row in each tree."""
    (grouped,), leaf_of = _grouped(points, dimensions, trees, leaf_rows, seed)

    def placed(table: pa.Table) -> pa.Table:
        row, _, leaf, tree = _group(table, dimensions, leaf_of)
        return pa.table({"row": row, "tree": np.full(len(row), tree, dtype=np.int32), "node": leaf})

    return grouped.groupBy("tree", "node").applyInArrow(placed, "row long, tree int, node long")


PIECES = "row long, others array<long>, distances array<double>"


def _pieces(points: DataFrame, dimensions: int, k: int, trees: int, leaf_rows: int, at_once: int) -> list[DataFrame]:
    """row, others, distances: the nearest rows in the leaf of a row, in one piece per tree; a
    table for so many trees at once."""
    tables, leaf_of = _grouped(points, dimensions, trees, leaf_rows, SEED, at_once)

    def nearest(row, x):
        squares = (x * x).sum(axis=1)
        wanted = min(k, len(row) - 1)
        for start in range(0, len(row), 1024):
            part = slice(start, min(start + 1024, len(row)))
            far = np.maximum(squares[part, None] + squares[None, :] - 2 * x[part] @ x.T, 0)
            own = np.arange(part.stop - start)
            far[own, own + start] = np.inf
            best = np.empty((len(own), wanted), dtype=np.int64)
            for i in range(wanted):
                best[:, i] = far.argmin(axis=1)
                far[own, best[:, i]] = np.inf
            # The distance of the chosen ones without the rounding of the squares.
            exact = np.sqrt(((x[part][:, None, :] - x[best]) ** 2).sum(axis=2))
            yield row[part], np.full(len(own), wanted), row[best].ravel(), exact.ravel()

    def pairs_of(table: pa.Table) -> pa.Table:
        row, x, leaf, _ = _group(table, dimensions, leaf_of)
        order = np.argsort(leaf, kind="stable")
        cuts = np.flatnonzero(np.diff(leaf[order])) + 1
        out = [part for own in np.split(order, cuts) for part in nearest(row[own], x[own])]
        found, sizes, others, far = (np.concatenate(c) for c in zip(*out))
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(c)) for c in (others.astype(np.int64), far)]
        return pa.table([pa.array(found), *lists], names=["row", "others", "distances"])

    return [grouped.groupBy("tree", "node").applyInArrow(pairs_of, PIECES) for grouped in tables]


def _nearest(pieces: DataFrame, k: int) -> DataFrame:
    """row, rank from 1, other, distance of the nearest ones in all pieces of a row."""
    # All pieces of a row come together once, for both steps.
    pairs = pieces.repartition("row").select("row", F.explode(F.arrays_zip("others", "distances")).alias("pair"))
    pairs = pairs.groupBy("row", F.col("pair.others").alias("other")).agg(F.min("pair.distances").alias("distance"))
    rank = F.row_number().over(W.partitionBy("row").orderBy("distance", "other")).alias("rank")
    return pairs.select("row", rank, "other", "distance").where(F.col("rank") <= k)


def neighbours(points: DataFrame, dimensions: int, k: int = NEIGHBOURS, trees: int = TREES, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """row, rank from 1, other, distance: the nearest other rows found, ties to the smaller
    row; fewer than ``k`` where there are no more rows."""
    return _nearest(_pieces(points, dimensions, k, trees, leaf_rows, trees)[0], k)


def _neighbours_in_steps(points: DataFrame, dimensions: int, k: int, trees: int, leaf_rows: int) -> DataFrame:
    """The same neighbours as a written table of one piece per row, nearest first; a few trees
    at a time."""
    best = None
    for pieces in _pieces(points, dimensions, k, trees, leaf_rows, TREES_AT_ONCE):
        last, both = best, pieces if best is None else pieces.unionByName(best)
        ordered = F.array_sort(F.collect_list(F.struct("distance", "other"))).alias("near")  # k at most
        kept = _nearest(both, k).groupBy("row").agg(ordered)
        best = _written(kept.select("row", F.col("near.other").alias("others"), F.col("near.distance").alias("distances")), "neighbours")
        if last is not None:
            _dropped(last)
    return best


def synthetic_rows(
    rare: DataFrame,
    times: int,
    features: Sequence[str] = FEATURES,
    key: str = ID,
    k: int = NEIGHBOURS,
    trees: int = TREES,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``times`` new rows per complete row of ``rare``: the features, and as ``parent`` and
    ``neighbour`` the keys of the rows they lie between, ``gap`` of the way from the first.

    A row without any other row has no neighbour and is repeated as it is. Flags become
    shares, as is usual for this method.
    """
    points = standard_rows(rare, features, key)
    known = _neighbours_in_steps(points, len(features), k, trees, leaf_rows).select("row", F.col("others").alias("near"))

    def copy_of(copy):
        place = F.pmod(F.xxhash64("row", copy, F.lit(1)), F.greatest(F.size("near"), F.lit(1))).cast("int")
        gap = F.pmod(F.xxhash64("row", copy, F.lit(2)), F.lit(HASH_STEPS)) / HASH_STEPS
        return F.struct(F.coalesce(F.get("near", place), F.col("row")).alias("other"), F.coalesce(gap, F.lit(0.0)).alias("gap"))

    numbers = F.sequence(F.lit(1), F.lit(times)) if times > 0 else F.array().cast("array<int>")
    rows = points.select("row", "key", "values").join(known, "row", "left")
    rows = rows.select("key", "values", F.transform(numbers, copy_of).alias("copies"))
    # A row goes once to each of its neighbours, whatever the number of new rows between them.
    rows = rows.select("*", F.explode(F.array_distinct(F.transform("copies", lambda c: c["other"]))).alias("other"))
    gaps = F.transform(F.filter("copies", lambda c: c["other"] == F.col("other")), lambda c: c["gap"])
    rows = rows.select("key", "values", "other", gaps.alias("gaps"))
    ends = points.select(F.col("row").alias("other"), F.col("key").alias("neighbour"), F.col("values").alias("far"))
    # No gap is NULL, so that the optimizer tells new rows from those of the table.
    out = rows.join(ends, "other").withColumn("gap", F.explode("gaps")).withColumn("gap", F.coalesce("gap", F.lit(0.0)))
    between = [(F.col("values")[i] + F.col("gap") * (F.col("far")[i] - F.col("values")[i])).alias(c) for i, c in enumerate(features)]
    return out.select(*between, F.col("key").alias("parent"), "neighbour", "gap")


def balanced(df: DataFrame, label: str = LABEL, features: Sequence[str] = FEATURES, key: str = ID, **settings) -> DataFrame:
    """The complete rows of a table with two classes, and new ones of the rarer class.

    Every rare row is the parent of equally many new ones, as many as do not make its class
    the larger one. Columns: label, features, key (NULL for new rows), parent, neighbour
    and gap (NULL for rows of the table).
    """
    rows = df.where(is_complete(features) & plain(label).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(plain(label)).count().limit(3).collect()}
    if len(sizes) > 2:
        raise ValueError("a label with two classes is expected")
    kept = rows.select(plain(label), *map(plain, features), plain(key).alias(key))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("parent", "string"), ("neighbour", "string"), ("gap", "double"))]
    kept = kept.select(*map(plain, kept.columns), *none)
    if len(sizes) < 2:
        return kept
    rare = min(sizes, key=lambda c: (sizes[c], c))
    times = max(sizes.values()) // sizes[rare] - 1
    new = synthetic_rows(rows.where(plain(label) == F.lit(rare)), times, features, key, **settings)
    new = new.withColumn(label, F.lit(rare).cast(df.schema[label].dataType)).withColumn(key, F.lit(None).cast(df.schema[key].dataType))
    return kept.unionByName(new.withColumn("parent", F.col("parent").cast("string")).withColumn("neighbour", F.col("neighbour").cast("string")))
