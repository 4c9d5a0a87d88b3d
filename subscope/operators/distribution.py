"""Per-class distributions of numeric columns: histograms, densities and box plots."""

import math
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bin_checked, bin_guess, name_at, numeric_columns
from ..schemas import LABEL
from ..sources.local import local_frame
from .longform import (
    GROUP,
    INDEX,
    SLOT,
    VALUE,
    Slots,
    long_values,
    slots_of,
)
from .quantiles import (
    Summary,
    bins_over_classes,
    class_bins,
    class_summary,
    exact_quantiles,
    over_classes,
)

# Grid points evaluated together in the density; a power of two below the field limit of
# whole-stage code generation.
GRID_BLOCK = 32

# Bins that stand for the values in densities: exact enough to draw, and bounded however
# many distinct values a column has.
DENSITY_RESOLUTION = 4096

# Exact densities: cells per bandwidth, terms of the series of a cell, and the distance in
# bandwidths from which a kernel is below the least double.
CELLS = 16
TERMS = 14
REACH = 39.0


def automatic_bins(count: int, low: float, high: float, iqr: float) -> int:
    """Bin count from the narrower of the Freedman-Diaconis and Sturges widths."""
    span = high - low
    if count == 0 or span == 0:
        return 1
    width = span / (math.log2(count) + 1)
    spread = 2.0 * iqr / count ** (1 / 3)
    if spread > 0:
        width = min(width, spread)
    return max(1, math.ceil(span / width))


def histogram_by_label(
    df: DataFrame,
    label: str = LABEL,
    columns: Iterable[str] | None = None,
    bins: int | str = "auto",
    summary: Summary | None = None,
    empty_bins: bool | None = None,
    binned: DataFrame | None = None,
) -> DataFrame:
    """Counts and densities per class over bin edges shared by all classes.

    Densities integrate to 1 within each class. Empty bins are part of the result where
    the number of bins is given, unless ``empty_bins`` says otherwise. ``bins="auto"``
    derives the number of bins from the whole column; a heavy tail makes it very large,
    so only occupied bins are returned, which the rows bound, and any edge follows from
    ``bin`` and the edges of another bin. ``summary``, the
    :func:`class_summary` of these columns, saves a pass where it is known already, and
    ``binned``, their :func:`class_bins`, another one.
    """
    names = numeric_columns(df, columns, {label})
    per_class = summary or class_summary(df, names, label)
    whole = over_classes(per_class)
    if bins == "auto":
        counted = None if binned is None else bins_over_classes(binned, names)
        exact_quantiles(df, names, (0.25, 0.75), summary=whole, counted=counted)
    edges = {}
    for (_, index), o in whole.items():
        number = bins
        if bins == "auto":
            iqr = o.quantile(0.75) - o.quantile(0.25)
            # Narrower bins than this have edges that doubles cannot tell apart.
            number = min(automatic_bins(o.count, o.low, o.high, iqr), 2**53)
        flat = o.low == o.high
        low, high = (o.low - 0.5, o.high + 0.5) if flat else (o.low, o.high)
        edges[index] = (low, high, (high - low) / number, int(number))

    if empty_bins is None:
        empty_bins = bins != "auto"
    if empty_bins and bins == "auto":
        raise ValueError("empty bins need a given number of bins")
    edge_fields = "_low double, _high double, _width double, _bins bigint"
    by_column = local_frame(
        df.sparkSession,
        [(i, *e) for i, e in edges.items()],
        f"{INDEX} int, {edge_fields}",
    )
    low, width, n_bins = F.col("_low"), F.col("_width"), F.col("_bins")
    # One row per column: the bound is the schema.
    counted = (
        long_values(df, names, label)
        .where(F.col(VALUE).isNotNull())
        .join(F.broadcast(by_column), INDEX)
        .withColumn("_guess", bin_guess(F.col(VALUE), low, width, n_bins))
        .select(
            GROUP,
            INDEX,
            bin_checked(F.col("_guess"), F.col(VALUE), low, width, n_bins).alias("bin"),
        )
        .groupBy(GROUP, INDEX, "bin")
        .count()
    )
    spine = slots_of(per_class, label, names).frame(
        df,
        {(g, i): (*edges[i], o.count) for (g, i), o in per_class.items()},
        [
            ("_low", T.DoubleType()),
            ("_high", T.DoubleType()),
            ("_width", T.DoubleType()),
            ("_bins", T.LongType()),
            ("_rows", T.LongType()),
        ],
    )
    same = spine[GROUP].eqNullSafe(counted[GROUP]) & (spine[INDEX] == counted[INDEX])
    if empty_bins:
        numbers = F.sequence(F.lit(0).cast("long"), n_bins - 1)
        spine = spine.withColumn("bin", F.explode(numbers))
        at, rows = spine["bin"], F.coalesce(counted["count"], F.lit(0))
        joined = spine.join(counted, same & (at == counted["bin"]), "left")
    else:
        at, rows = counted["bin"], counted["count"]
        joined = counted.join(F.broadcast(spine), same)
    return joined.select(
        spine[GROUP].alias(label),
        name_at(names, spine[INDEX]).alias("column"),
        at.alias("bin"),
        (low + at * width).alias("bin_low"),
        F.when(at == n_bins - 1, F.col("_high"))
        .otherwise(low + (at + 1) * width)
        .alias("bin_high"),
        rows.alias("count"),
        (rows / (F.col("_rows") * width)).alias("density"),
    )


def density_by_label(
    df: DataFrame,
    label: str = LABEL,
    columns: Iterable[str] | None = None,
    grid: int = 200,
    resolution: int | None = DENSITY_RESOLUTION,
    summary: Summary | None = None,
    binned: DataFrame | None = None,
) -> DataFrame:
    """Gaussian kernel density per class on a grid shared by all classes.

    The bandwidth is the class's sample deviation times ``n ** (-1/5)``; the grid spans
    the column's range. A class with fewer than two distinct values has no curve.

    Values are first gathered in ``resolution`` equal bins at their mean, which bounds
    the work and the shuffle per class by the bins instead of the distinct values. As the
    mean is kept, the error of a point is of second order in the bin's width over the
    bandwidth. ``resolution=None`` lets every value enter as it is, see :func:`_exact_sums`.
    ``binned``, the :func:`class_bins` with that resolution, saves the pass over the values.
    """
    names = numeric_columns(df, columns, {label})
    per_class = summary or class_summary(df, names, label)
    whole = over_classes(per_class)
    shapes = {}
    for key, o in per_class.items():
        if o.low == o.high:
            continue
        column = whole[0, key[1]]
        bandwidth = o.std * o.count ** (-0.2)
        step = (column.high - column.low) / (grid - 1)
        shapes[key] = (column.low, step, bandwidth, o.count)
    slots = slots_of(per_class, label, names)
    # One row per (class, column) pair, checked above.
    shape = F.broadcast(
        slots.frame(
            df,
            shapes,
            [(n, T.DoubleType()) for n in ("_low", "_step", "_bandwidth")]
            + [("_rows", T.LongType())],
        )
    )

    placed = slots.long(df, dict(enumerate(names)))
    point = F.col("_point")
    if resolution is None:
        starts = slots.frame(df, {key: (per_class[key].low,) for key in shapes}, [("_from", T.DoubleType())])
        summed = _exact_sums(placed, shape.join(F.broadcast(starts.select(SLOT, "_from")), SLOT), grid)
    else:
        gathered = binned if binned is not None else class_bins(df, names, label, per_class, resolution)
        summed = _binned_sums(gathered, shape, grid)
    scale = F.col("_rows") * F.col("_bandwidth") * math.sqrt(2 * math.pi)
    return summed.join(shape, SLOT).select(
        F.col(GROUP).alias(label),
        name_at(names, F.col(INDEX)).alias("column"),
        point.alias("point"),
        (F.col("_low") + point * F.col("_step")).alias("x"),
        (F.col("_sum") / scale).alias("density"),
    )


def _exact_sums(placed: DataFrame, shape: DataFrame, grid: int) -> DataFrame:
    """Slot, ``_point`` and the sum of the kernels of all values.

    A cell is a sixteenth of the bandwidth wide and keeps the sums of powers of the distances
    of its values to its middle. For a value at distance t from the middle c, in bandwidths,
    exp(-(u - t)^2 / 2) = exp(-u^2 / 2) exp(-t^2 / 2) sum((u t)^k / k!), with u the distance
    of a point from c. As t is at most 1/32, TERMS of the series leave out less than 4e-16 of
    a kernel's value where it is above 1e-45, and 2e-10 of it where it is near the least
    double. So the densities are those of all values to the rounding of their sum. Values do
    not travel, and the cells of a class grow with its range in bandwidths.
    """
    width = F.col("_bandwidth") / CELLS
    celled = placed.join(F.broadcast(shape.select(SLOT, "_from", "_bandwidth")), SLOT).withColumn(
        "_cell", F.floor((F.col(VALUE) - F.col("_from")) / width)
    )
    middle = F.col("_from") + (F.col("_cell") + 0.5) * width
    near = celled.select(SLOT, "_cell", ((F.col(VALUE) - middle) / F.col("_bandwidth")).alias("_t"))
    weighted = near.withColumn("_m0", F.exp(-0.5 * F.col("_t") * F.col("_t")))
    power = F.col("_m0")
    sums = [F.sum(power).alias("_m0")]
    for k in range(1, TERMS):
        power = power * F.col("_t")
        sums.append(F.sum(power).alias(f"_m{k}"))
    cells = weighted.groupBy(SLOT, "_cell").agg(*sums)

    at = F.col("_low") + F.col("_point") * F.col("_step")
    met = cells.join(shape, SLOT).withColumn("_point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    met = met.withColumn("_u", (at - middle) / F.col("_bandwidth"))
    # The powers of u by Horner's rule, each with its factor of the factorial.
    series = F.col(f"_m{TERMS - 1}")
    for k in range(TERMS - 1, 0, -1):
        series = F.col(f"_m{k - 1}") + series * F.col("_u") / k
    # Beyond this distance the kernel is zero, and the series does not meet it.
    u2 = F.col("_u") * F.col("_u")
    kernels = F.when(F.abs("_u") < REACH, F.exp(-0.5 * u2) * series).otherwise(0.0)
    return met.groupBy(SLOT, "_point").agg(F.sum(kernels).alias("_sum"))


def _binned_sums(gathered: DataFrame, shape: DataFrame, grid: int) -> DataFrame:
    """Slot, ``_point`` and the sum of the kernels of the means of equal bins."""
    # Each gathered value meets the grid in blocks of neighbouring points. One block is
    # one narrow row with a fixed set of sums, combined before the shuffle.
    blocks = math.ceil(grid / GRID_BLOCK)
    start = F.col("_low") + F.col("_block") * GRID_BLOCK * F.col("_step")
    spread = (
        gathered.join(shape, SLOT)
        .select(
            *[SLOT, VALUE, "n", "_low", "_step", "_bandwidth"],
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"),
        )
        .select(
            *[SLOT, "_block", "n"],
            ((start - F.col(VALUE)) / F.col("_bandwidth")).alias("_offset"),
            (F.col("_step") / F.col("_bandwidth")).alias("_pace"),
        )
    )

    def kernel(k: int) -> Column:
        distance = F.col("_offset") + k * F.col("_pace")
        return F.sum(F.col("n") * F.exp(-0.5 * distance * distance))

    summed = spread.groupBy(SLOT, "_block").agg(
        *[kernel(k).alias(f"_k{k}") for k in range(GRID_BLOCK)]
    )
    point = F.col("_block") * GRID_BLOCK + F.col("_k")
    summed = summed.select(
        *[SLOT, "_block"],
        F.posexplode(F.array(*[f"_k{k}" for k in range(GRID_BLOCK)])).alias("_k", "_sum"),
    )
    return summed.where(point < grid).select(SLOT, point.alias("_point"), "_sum")


def box_stats_by_label(
    df: DataFrame,
    label: str = LABEL,
    columns: Iterable[str] | None = None,
    method: str = "exact",
    accuracy: int = 10_000,
    summary: Summary | None = None,
    binned: DataFrame | None = None,
) -> DataFrame:
    """Quartiles, whiskers and outlier counts per class.

    Whiskers reach the furthest value within 1.5 interquartile ranges of the box.
    ``method="approx"`` takes values whose ranks are within a share of ``1 / accuracy`` of
    the quartiles', which saves passes. ``binned``, the :func:`class_bins` of these columns,
    goes with ``summary`` and saves the first pass for quartiles; whiskers and outliers are
    then counted from it, but for bins that a fence cuts.
    """
    names = numeric_columns(df, columns, {label})
    quartiles = (0.25, 0.5, 0.75)
    if method not in ("exact", "approx"):
        raise ValueError("method is 'exact' or 'approx'")
    if method == "approx" and summary is not None:
        # Ranks found nearly stay out of what exact ones may be added to.
        summary = {key: replace(o, at_rank={}) for key, o in summary.items()}
    tolerance = 0.0 if method == "exact" else 1 / accuracy
    ordered = exact_quantiles(df, names, quartiles, label, summary, tolerance=tolerance, counted=binned)
    boxes = {key: (o.count, [o.quantile(p) for p in quartiles]) for key, o in ordered.items()}

    shapes = {}
    for key, (count, (q1, median, q3)) in boxes.items():
        reach = 1.5 * (q3 - q1)
        shapes[key] = (count, q1, median, q3, q1 - reach, q3 + reach)
    slots = slots_of(shapes, label, names)
    # One row per (class, column) pair, checked when the quartiles were collected.
    shape = F.broadcast(
        slots.frame(
            df,
            shapes,
            [("count", T.LongType())]
            + [
                (n, T.DoubleType()) for n in ("q1", "median", "q3", "_floor", "_ceiling")
            ],
        )
    )
    inside = F.col(VALUE).between(F.col("_floor"), F.col("_ceiling"))
    fences = shape.select(SLOT, "_floor", "_ceiling")
    fenced = slots.long(df, dict(enumerate(names))).join(F.broadcast(fences), SLOT)
    found = (
        F.min(F.when(inside, F.col(VALUE))).alias("_lowest"),
        F.max(F.when(inside, F.col(VALUE))).alias("_highest"),
        F.count_if(~inside).alias("outliers"),
    )
    if binned is None:
        sides = fenced.groupBy(SLOT).agg(*found)
    else:
        sides = _sides(fenced, found, binned, fences, slots, shapes)
    return (
        sides.join(shape, SLOT)
        .select(
            F.col(GROUP).alias(label),
            name_at(names, F.col(INDEX)).alias("column"),
            "count",
            "q1",
            "median",
            "q3",
            F.least("_lowest", "q1").alias("whisker_low"),
            F.greatest("_highest", "q3").alias("whisker_high"),
            "outliers",
        )
    )


def _sides(fenced, found, binned: DataFrame, fences: DataFrame, slots: Slots, shapes: dict) -> DataFrame:
    """Slot, furthest values inside the fences and number of those outside."""
    met = binned.join(F.broadcast(fences), SLOT)
    floor, ceiling = F.col("_floor"), F.col("_ceiling")
    cut = ((F.col("low") < floor) & (F.col("high") >= floor)) | ((F.col("low") <= ceiling) & (F.col("high") > ceiling))
    inside = F.col("low").between(floor, ceiling)
    whole = met.where(~cut).groupBy(SLOT).agg(
        F.min(F.when(inside, F.col("low"))).alias("_lowest"),
        F.max(F.when(inside, F.col("high"))).alias("_highest"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
    )
    # A bin is cut by at most two fences, so there are at most two per slot.
    edges = met.where(cut).select(SLOT, "low", "high")
    values = fenced.join(F.broadcast(edges), SLOT).where(F.col(VALUE).between(F.col("low"), F.col("high")))
    # Slots of columns that do not vary have no bins, and no value outside.
    flat = local_frame(
        fenced.sparkSession,
        [(slots.number(*key), s[1], s[1], 0) for key, s in shapes.items()],
        f"{SLOT} int, _lowest double, _highest double, outliers long",
    ).join(binned.select(SLOT).distinct(), SLOT, "left_anti")
    parts = whole.unionByName(values.groupBy(SLOT).agg(*found)).unionByName(flat)
    return parts.groupBy(SLOT).agg(F.min("_lowest").alias("_lowest"), F.max("_highest").alias("_highest"), F.sum("outliers").alias("outliers"))
