"""Pairwise-complete Pearson correlation.

Two passes: means, then sums of products of the centred columns. In the second pass a task
adds its batches up in matrices of columns by columns, which Spark sums over the tasks. The
plan does not grow with the columns, and one small row per pair reaches the driver.
"""

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions import finite, numeric_columns, plain
from ..sources.local import local_frame
from .longform import INDEX, VALUE, long_values

PAIR_SCHEMA = (
    "row_index int, row_name string, column_index int, column_name string, "
    "correlation double"
)


def correlation_matrix(
    df: DataFrame, columns: Iterable[str] | None = None
) -> DataFrame:
    """Long form of the full matrix: one row per ordered pair of numeric columns.

    A pair uses the rows in which both values are present. The correlation is NULL where
    one of the two does not vary over those rows.
    """
    names = numeric_columns(df, columns)
    if not names:
        return local_frame(df.sparkSession, [], PAIR_SCHEMA)
    first = long_values(df, names).groupBy(INDEX)
    base = {
        r[INDEX]: r
        for r in first.agg(
            F.count(F.lit(1)).alias("total"),
            F.count(VALUE).alias("n"),
            F.avg(VALUE).alias("mean"),
            F.min(VALUE).alias("low"),
            F.max(VALUE).alias("high"),
        ).collect()
    }
    partial = {i for i, r in base.items() if r["n"] < r["total"]}
    sums = {(r["i"], r["j"]): r for r in _centred_sums(df, names, base, partial).collect()}
    rows = [
        (i, names[i], j, names[j], _pearson(i, j, sums, base, partial))
        for i in range(len(names))
        for j in range(len(names))
    ]
    return local_frame(df.sparkSession, rows, PAIR_SCHEMA)


def _centred_sums(
    df: DataFrame, names: list[str], base: dict[int, Row], partial: set[int]
) -> DataFrame:
    """Per pair the sum of products ``p`` of the rows that have both, and of column ``i`` in
    these rows the number, sum, sum of squares and, where ``j`` has gaps, the extremes."""
    width, gaps = len(names), sorted(partial)
    whole = [j for j in range(width) if j not in partial]
    means = np.array([(base[i]["mean"] if i in base else None) or 0.0 for i in range(width)])

    def run(batches):
        p, n, s, q = np.zeros((4, width, width))
        low, high = np.full((width, width), np.inf), np.full((width, width), -np.inf)
        for batch in batches:
            values = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)]
            x = np.stack(values, axis=1).astype(np.float64)
            known = np.isfinite(x)
            z = np.where(known, x - means, 0.0)
            p += z.T @ z
            there = known[:, gaps].astype(np.float64)
            for total, x in ((n, known.astype(np.float64)), (s, z), (q, z * z)):
                total[:, whole] += x.sum(axis=0)[:, None]
                total[:, gaps] += x.T @ there
            for j in gaps:
                both = known & known[:, [j]]
                low[:, j] = np.minimum(low[:, j], np.where(both, z, np.inf).min(axis=0, initial=np.inf))
                high[:, j] = np.maximum(high[:, j], np.where(both, z, -np.inf).max(axis=0, initial=-np.inf))
        i, j = (x.ravel() for x in np.indices((width, width), dtype=np.int32))
        figures = [m.ravel() for m in (n.astype(np.int64), p, s, q, low, high)]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, (i, j, *figures))), names=["i", "j", "n", "p", "s", "q", "low", "high"])

    narrow = df.select(*[finite(plain(c)).alias(f"z{i}") for i, c in enumerate(names)])
    parts = narrow.mapInArrow(run, "i int, j int, n long, p double, s double, q double, low double, high double")
    totals = [F.sum(c).alias(c) for c in "npsq"]
    return parts.groupBy("i", "j").agg(*totals, F.min("low").alias("low"), F.max("high").alias("high"))


def _spread(
    i: int, j: int, sums: dict[tuple[int, int], Row], base: dict[int, Row], partial: set[int]
) -> tuple[int, float, float]:
    """Rows, sum and sum of squared deviations of column i where j is present."""
    r = sums[i, j]
    n, s, q = r["n"], r["s"], r["q"]
    if n == 0:
        return 0, 0.0, 0.0
    low, high = (r["low"], r["high"]) if j in partial else (base[i]["low"], base[i]["high"])
    return n, s, (q - s * s / n if low != high else 0.0)


def _pearson(
    i: int, j: int, sums: dict[tuple[int, int], Row], base: dict[int, Row], partial: set[int]
) -> float | None:
    if (i, j) not in sums:
        return None
    n, s_i, d_i = _spread(i, j, sums, base, partial)
    _, s_j, d_j = _spread(j, i, sums, base, partial)
    if n == 0 or d_i <= 0 or d_j <= 0:
        return None
    if i == j:
        return 1.0
    # From one of the two orders, so that the matrix is symmetric.
    shared = sums[min(i, j), max(i, j)]["p"] - s_i * s_j / n
    value = shared / (math.sqrt(d_i) * math.sqrt(d_j))
    return max(-1.0, min(1.0, value))


def correlation_lower(
    df: DataFrame, columns: Iterable[str] | None = None
) -> DataFrame:
    """The pairs strictly below the diagonal."""
    matrix = correlation_matrix(df, columns)
    return matrix.where(F.col("row_index") > F.col("column_index"))
