"""Stored moments of ingestion parts, merged instead of computed again.

A part of the data, such as a day, leaves one row per pair of numeric columns: over the rows
that have both values, their number, both means, both sums of squared deviations and the sum
of products of deviations. Such rows merge exactly (up to rounding), in any order and
grouping, so means, deviations, cleaning bounds and correlations of all data are renewed by
reading the new part alone and a small table of the others.

A task adds its rows up in matrices of columns by columns, whatever their number. Deviations
are taken from means of batches, so nothing is lost when values are large and close.

NULL, NaN and infinities do not enter; ``missing`` counts NULL and NaN.
"""

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import numeric_columns, plain
from ..sources.local import local_frame
from .cleaning import SigmaCapModel, SigmaCapper

FIGURES = ("n", "mean_a", "mean_b", "m2_a", "m2_b", "c")
SCHEMA = (
    "a string, b string, n long, mean_a double, mean_b double, m2_a double, m2_b double, c double, "
    "rows long, missing long, least double, greatest double"
)
COLUMNS = ("a", "b", *FIGURES, "rows", "missing", "least", "greatest")
# Deviations below this share of the mean are rounding: the values do not vary.
ROUNDING = 1e-12


class Sums:
    """Moments of all pairs of columns of the rows seen so far."""

    def __init__(self, width: int):
        self.rows = 0
        self.missing = np.zeros(width, dtype=np.int64)
        self.least, self.greatest = np.full(width, np.inf), np.full(width, -np.inf)
        self.figures = np.zeros((6, width, width))

    def add(self, x: np.ndarray) -> None:
        """Rows of values, NaN where there is none."""
        known = np.isfinite(x)
        self.rows += len(x)
        self.missing += np.isnan(x).sum(axis=0)
        self.least = np.minimum(self.least, np.where(known, x, np.inf).min(axis=0, initial=np.inf))
        self.greatest = np.maximum(self.greatest, np.where(known, x, -np.inf).max(axis=0, initial=-np.inf))
        mask = known.astype(np.float64)
        seen = np.maximum(mask.sum(axis=0), 1)
        shift = np.where(known, x, 0).sum(axis=0) / seen
        centred = np.where(known, x - shift, 0)
        n = mask.T @ mask
        sums = centred.T @ mask
        share = sums / np.maximum(n, 1)
        m2 = np.maximum((centred * centred).T @ mask - sums * share, 0)
        c = centred.T @ centred - sums * share.T
        mean = share + shift[:, None]
        self.merge(np.stack((n, mean, mean.T, m2, m2.T, c)))

    def merge(self, other: np.ndarray) -> None:
        n, mean_a, mean_b, m2_a, m2_b, c = self.figures
        k, other_a, other_b, *rest = other
        total = np.maximum(n + k, 1)
        weight = n * k / total
        step_a, step_b = other_a - mean_a, other_b - mean_b
        self.figures = np.stack(
            (
                n + k,
                np.where(n + k > 0, mean_a + step_a * k / total, 0),
                np.where(n + k > 0, mean_b + step_b * k / total, 0),
                m2_a + rest[0] + step_a * step_a * weight,
                m2_b + rest[1] + step_b * step_b * weight,
                c + rest[2] + step_a * step_b * weight,
            )
        )

    def batch(self, names: Sequence[str]) -> pa.RecordBatch:
        i, j = np.triu_indices(len(names))
        own = i == j
        pick = [pa.array([names[x] for x in k], pa.string()) for k in (i, j)]
        figures = [f[i, j] for f in self.figures]
        figures[0] = figures[0].astype(np.int64)
        seen = own & (self.figures[0][i, j] > 0)
        ends = [pa.array(v[i], mask=~seen) for v in (self.least, self.greatest)]
        counts = [pa.array(np.full(len(i), self.rows)), pa.array(self.missing[i], mask=~own)]
        return pa.RecordBatch.from_arrays([*pick, *map(pa.array, figures), *counts, *ends], names=list(COLUMNS))


def part_moments(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per pair of columns (each with itself as well), the first one first."""
    names = numeric_columns(df, columns)
    if not names:
        return local_frame(df.sparkSession, [], SCHEMA)

    def run(batches):
        sums = Sums(len(names))
        for batch in batches:
            if len(batch):
                values = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(names))]
                sums.add(np.stack(values, axis=1).astype(np.float64))
        yield sums.batch(names)

    values = df.select(*(plain(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)))
    # Without any task there are still rows for all pairs.
    none = [tuple(r.values()) for r in Sums(len(names)).batch(names).to_pylist()]
    return merged(local_frame(df.sparkSession, none, SCHEMA).unionByName(values.mapInArrow(run, SCHEMA)))


def merged(moments: DataFrame) -> DataFrame:
    """One row per pair of columns from those of any parts."""
    pair = W.partitionBy("a", "b")
    total = F.sum("n").over(pair)
    # Means are compared with one of them, so that large and close ones lose no digits.
    first = {f"first_{s}": F.min(F.when(F.col("n") > 0, F.col(f"mean_{s}"))).over(pair) for s in "ab"}
    table = moments.select(*COLUMNS).withColumns(first)
    apart = {s: F.coalesce(F.col(f"mean_{s}") - F.col(f"first_{s}"), F.lit(0.0)) for s in "ab"}
    table = table.withColumns({f"all_{s}": F.coalesce(F.sum(F.col("n") * apart[s]).over(pair) / F.nullif(total, F.lit(0)), F.lit(0.0)) for s in "ab"})
    step = {s: F.when(F.col("n") > 0, apart[s] - F.col(f"all_{s}")).otherwise(0.0) for s in "ab"}
    return table.groupBy("a", "b").agg(
        F.sum("n").alias("n"),
        *(F.coalesce(F.first(F.col(f"first_{s}") + F.col(f"all_{s}")), F.lit(0.0)).alias(f"mean_{s}") for s in "ab"),
        F.sum(F.col("m2_a") + F.col("n") * step["a"] * step["a"]).alias("m2_a"),
        F.sum(F.col("m2_b") + F.col("n") * step["b"] * step["b"]).alias("m2_b"),
        F.sum(F.col("c") + F.col("n") * step["a"] * step["b"]).alias("c"),
        F.sum("rows").alias("rows"),
        F.sum("missing").alias("missing"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
    )


def store_part(df: DataFrame, path: str, part: str, columns: Iterable[str] | None = None) -> None:
    """Write the moments of one part. A part that is written again replaces itself."""
    target = f"{path.rstrip('/')}/part={part}"
    part_moments(df, columns).coalesce(1).write.mode("overwrite").parquet(target)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The moments of all parts, with the part's name."""
    return spark.read.option("basePath", path).schema(SCHEMA + ", part string").parquet(path)


def profile(moments: DataFrame) -> DataFrame:
    """column, mean, std, min, max, row_count, known and null_count of merged moments."""
    own = moments.where("a = b")
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2_a") / (F.col("n") - 1)))
    return own.select(
        F.col("a").alias("column"),
        F.when(F.col("n") > 0, F.col("mean_a")).alias("mean"),
        deviation.alias("std"),
        F.col("least").alias("min"),
        F.col("greatest").alias("max"),
        F.col("rows").alias("row_count"),
        F.col("n").alias("known"),
        F.col("missing").alias("null_count"),
    )


def bounds(moments: DataFrame, capper: SigmaCapper | None = None) -> SigmaCapModel:
    """The cleaning model that the capper would fit on all parts' rows; one row per column
    comes to the driver."""
    capper = capper or SigmaCapper()
    rows = {r["column"]: r for r in profile(moments).collect()}
    names = [c for c in (capper.columns or sorted(rows)) if c not in capper.exclude and c in rows]
    return SigmaCapModel([capper.of_moments(c, rows[c]["mean"], rows[c]["std"]) for c in names])


def correlation(moments: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The matrix of the named columns in long form, NULL where one of the two does not vary
    over the rows that have both."""
    place = F.create_map(*(x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))))
    varies = [F.col(f"m2_{s}") > F.col("n") * F.pow(F.col(f"mean_{s}") * ROUNDING, 2) for s in "ab"]
    value = F.when(varies[0] & varies[1], F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("c") / F.sqrt("m2_a") / F.sqrt("m2_b"))))
    pairs = moments.where(F.col("a").isin(*columns) & F.col("b").isin(*columns)).select("a", "b", value.alias("correlation"))
    both = pairs.unionByName(pairs.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "correlation"))
    return both.select(
        place[F.col("a")].alias("row_index"), F.col("a").alias("row_name"), place[F.col("b")].alias("column_index"), F.col("b").alias("column_name"), "correlation"
    )
