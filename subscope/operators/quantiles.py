"""Exact quantiles by repeated narrowing.

Every pass counts the values of the still open intervals in equal-width bins. The bin
that holds a wanted rank, cut to the smallest and largest value seen in it, is the next
interval. A pass shuffles bin counts only, never values, so no class, column or heavy
value has to fit into one task. An interval always shrinks, because its two ends fall
into different bins; the search ends when a rank meets an end of its interval.
"""

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bin_guess
from ..sources.local import local_frame
from .longform import (
    GROUP,
    INDEX,
    SLOT,
    VALUE,
    Slots,
    collect_classes,
    long_values,
    slots_of,
)

# Few enough that the groups of some dozen intervals stay in the fast aggregation map.
BINS = 1024


@dataclass
class Ordered:
    """Order statistics of one column within one class."""

    count: int
    low: float
    high: float
    std: float | None = None
    at_rank: dict[int, float] = field(default_factory=dict)

    def positions(self, probability: float) -> tuple[int, int, float]:
        place = probability * (self.count - 1)
        below = math.floor(place)
        return below, math.ceil(place), place - below

    def quantile(self, probability: float) -> float:
        """Linear interpolation between the two neighbouring values."""
        below, above, part = self.positions(probability)
        start = self.at_rank[below]
        return start + (self.at_rank[above] - start) * part


# Order statistics by class and column index.
Summary = dict[tuple[Any, int], Ordered]


@dataclass(frozen=True)
class _Interval:
    key: tuple[Any, int]
    low: float
    high: float
    before: int


def class_summary(
    df: DataFrame, columns: Sequence[str], by: str | None = None
) -> Summary:
    """Count, extremes and deviation per class and column, without missing values."""
    grouped = (
        long_values(df, columns, by)
        .where(F.col(VALUE).isNotNull())
        .groupBy(GROUP, INDEX)
        .agg(
            F.count(VALUE).alias("n"),
            F.min(VALUE).alias("low"),
            F.max(VALUE).alias("high"),
            F.stddev_samp(VALUE).alias("std"),
        )
    )
    return {
        (r[GROUP], r[INDEX]): Ordered(r["n"], r["low"], r["high"], r["std"])
        for r in collect_classes(grouped)
    }


def over_classes(per_class: Summary) -> Summary:
    """The extremes of each column over all classes, under the group of no class."""
    merged: Summary = {}
    for (_, index), o in per_class.items():
        known = merged.get((0, index))
        merged[0, index] = (
            Ordered(o.count, o.low, o.high)
            if known is None
            else Ordered(
                known.count + o.count, min(known.low, o.low), max(known.high, o.high)
            )
        )
    return merged


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Iterable[float],
    by: str | None = None,
    summary: Summary | None = None,
    bins: int = BINS,
    tolerance: float = 0.0,
    counted: DataFrame | None = None,
) -> Summary:
    """Per (class, column index) the order statistics behind the given probabilities.

    ``summary`` saves the first pass where it is known already; ranks found are added to
    it. With a ``tolerance`` a value may stand for a rank that is off by that share of the
    class's values, which saves the last passes. ``counted``, the counts of :func:`in_bins`
    under the slots of ``summary``, takes the place of the first narrowing pass.
    """
    found = summary
    if found is None:
        found = class_summary(df, columns, by)
    slots = slots_of(found, by, columns)
    open_ranks: dict[_Interval, set[int]] = {}
    for key, ordered in found.items():
        interval = _Interval(key, ordered.low, ordered.high, 0)
        for p in probabilities:
            for rank in ordered.positions(p)[:2]:
                _place(ordered, interval, ordered.count, rank, open_ranks, tolerance)
    while open_ranks:
        if counted is None:
            open_ranks = _narrow(df, columns, slots, found, open_ranks, bins, tolerance)
        else:
            ids = [(i, slots.number(*interval.key)) for i, interval in enumerate(open_ranks)]
            bounds = local_frame(df.sparkSession, ids, f"_id int, {SLOT} int")
            first = counted.join(F.broadcast(bounds), SLOT).select("_id", "_bin", "n", "low", "high")
            open_ranks, counted = _hits(first, found, open_ranks, tolerance), None
    return found


def in_bins(values: DataFrame, spans: DataFrame, number: int) -> DataFrame:
    """Per slot and equal-width bin of its span the mean, count and extremes of the values.

    ``values`` are those of ``Slots.long``; ``spans`` has a row (slot, ``_from``, ``_to``)
    per slot that is wanted.
    """
    width = (F.col("_to") - F.col("_from")) / number
    bin_number = bin_guess(F.col(VALUE), F.col("_from"), width, F.lit(number))
    return (
        values.join(F.broadcast(spans), SLOT)
        .groupBy(SLOT, bin_number.alias("_bin"))
        .agg(
            F.avg(VALUE).alias(VALUE),
            F.count(VALUE).alias("n"),
            F.min(VALUE).alias("low"),
            F.max(VALUE).alias("high"),
        )
    )


def class_bins(df: DataFrame, columns: Sequence[str], by: str, summary: Summary, number: int) -> DataFrame:
    """:func:`in_bins` of all classes, over the span of each column that varies."""
    slots, whole = slots_of(summary, by, columns), over_classes(summary)
    # The least double keeps the bins of a span of a few of them from having no width.
    spans = [
        (slots.number(g, i), whole[0, i].low, max(whole[0, i].high, whole[0, i].low + number * 5e-324))
        for g, i in summary
        if whole[0, i].low != whole[0, i].high
    ]
    spans = local_frame(df.sparkSession, spans, f"{SLOT} int, _from double, _to double")
    return in_bins(slots.long(df, dict(enumerate(columns))), spans, number)


def bins_over_classes(binned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The counts of :func:`class_bins` under the slots of the group of no class."""
    column = (F.col(SLOT) % len(columns)).alias(SLOT)
    totals = (F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    return binned.groupBy(column, "_bin").agg(*totals)


def _place(
    ordered: Ordered,
    interval: _Interval,
    rows: int,
    rank: int,
    open_ranks: dict[_Interval, set[int]],
    tolerance: float,
) -> None:
    """Settle a rank at an end of its interval, or leave it open."""
    last = interval.before + rows - 1
    if interval.low == interval.high or rank == interval.before:
        ordered.at_rank[rank] = interval.low
    elif rank == last:
        ordered.at_rank[rank] = interval.high
    elif rows - 1 <= tolerance * ordered.count:
        nearer_low = rank - interval.before <= last - rank
        ordered.at_rank[rank] = interval.low if nearer_low else interval.high
    else:
        open_ranks.setdefault(interval, set()).add(rank)


def _narrow(
    df: DataFrame,
    columns: Sequence[str],
    slots: Slots,
    found: Summary,
    open_ranks: dict[_Interval, set[int]],
    bins: int,
    tolerance: float,
) -> dict[_Interval, set[int]]:
    intervals = list(open_ranks)
    rows = []
    for i, interval in enumerate(intervals):
        # Halving keeps the width finite for ends of opposite sign and huge size.
        scale = 1.0 if math.isfinite(interval.high - interval.low) else 0.5
        start = interval.low * scale
        width = interval.high * scale - start
        slot = slots.number(*interval.key)
        rows.append((i, slot, interval.low, interval.high, scale, start, width))

    spark = df.sparkSession
    bounds = local_frame(
        spark,
        rows,
        f"_id int, {SLOT} int, _low double, _high double, _scale double, "
        "_start double, _width double",
    )
    # Both small frames have at most a few rows per (class, column) pair, and the number
    # of pairs is checked when the summary is collected. Columns whose ranks are all
    # settled are not read again.
    still_read = sorted({interval.key[1] for interval in intervals})
    values = slots.long(df, {i: columns[i] for i in still_read})
    share = (F.col(VALUE) * F.col("_scale") - F.col("_start")) / F.col("_width")
    counted = (
        values.join(F.broadcast(bounds), SLOT)
        .where(F.col(VALUE).between(F.col("_low"), F.col("_high")))
        .select(
            "_id", F.least(F.floor(share * bins), F.lit(bins - 1)).alias("_bin"), VALUE
        )
        .groupBy("_id", "_bin")
        .agg(
            F.count(VALUE).alias("n"),
            F.min(VALUE).alias("low"),
            F.max(VALUE).alias("high"),
        )
    )
    return _hits(counted, found, open_ranks, tolerance)


def _hits(
    counted: DataFrame,
    found: Summary,
    open_ranks: dict[_Interval, set[int]],
    tolerance: float,
) -> dict[_Interval, set[int]]:
    """Settle or narrow the open ranks by the counts of the bins of their intervals."""
    intervals = list(open_ranks)
    targets = [(i, rank - interval.before) for i, interval in enumerate(intervals) for rank in open_ranks[interval]]
    wanted = local_frame(counted.sparkSession, targets, "_id int, _offset long")
    # At most as many rows per interval as it has bins reach the window.
    through = F.sum("n").over(Window.partitionBy("_id").orderBy("_bin"))
    hits = (
        counted.withColumn("_through", through)
        .join(F.broadcast(wanted), "_id")
        .where(
            (F.col("_offset") < F.col("_through"))
            & (F.col("_offset") >= F.col("_through") - F.col("n"))
        )
        .collect()
    )

    still_open: dict[_Interval, set[int]] = {}
    for hit in hits:
        outer = intervals[hit["_id"]]
        before = outer.before + hit["_through"] - hit["n"]
        inner = _Interval(outer.key, hit["low"], hit["high"], before)
        rank = outer.before + hit["_offset"]
        _place(found[outer.key], inner, hit["n"], rank, still_open, tolerance)
    return still_open
