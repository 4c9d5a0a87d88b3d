"""One narrow row per numeric value, the common input of the per-column statistics.

Exploding an array of the columns keeps the aggregation small: a handful of buffers
under an integer key, whatever the number of columns. A single aggregate with several
buffers for each of many columns leaves whole-stage code generation instead, because it
exceeds ``spark.sql.codegen.maxFields``. Partial aggregation reduces the exploded rows
inside the scan task, so only groups are shuffled.
"""

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import finite, plain
from ..sources.local import local_frame

GROUP = "_group"
INDEX = "_index"
VALUE = "_value"
SLOT = "_slot"

# Most (class, column) pairs a per-class statistic brings to the driver.
MAX_CLASS_COLUMNS = 100_000


def long_values(
    df: DataFrame,
    columns: Sequence[str],
    by: str | None = None,
    value: Callable[[Column], Column] = finite,
) -> DataFrame:
    """Rows (``_group``, ``_index``, ``_value``); without ``by`` the group is 0."""
    group = F.lit(0) if by is None else plain(by)
    values = F.array(*[value(plain(c)) for c in columns])
    return df.select(group.alias(GROUP), F.posexplode(values).alias(INDEX, VALUE))


@dataclass(frozen=True)
class Slots:
    """One integer for every pair of a known class and a column.

    Once the classes are known, the passes that look something up per class and column
    join on this integer, which Spark keeps in a compact hash table.
    """

    by: str | None
    classes: tuple[Any, ...]
    width: int

    @cached_property
    def _positions(self) -> dict[Any, int]:
        return {group: k for k, group in enumerate(self.classes)}

    def number(self, group: Any, index: int) -> int:
        return self._positions[group] * self.width + index

    def long(self, df: DataFrame, columns: Mapping[int, str]) -> DataFrame:
        """Rows (``_slot``, ``_value``) of some of the columns, without missing values."""
        values = F.array(*[finite(plain(c)) for c in columns.values()])
        offsets = F.array(*[F.lit(i) for i in columns])
        first = F.lit(0)
        if self.by is not None:
            known = self._frame(
                df,
                [(g, k * self.width) for k, g in enumerate(self.classes)],
                [("_first", T.IntegerType())],
            )
            # One row per class, checked when the classes were collected.
            same = plain(self.by).eqNullSafe(known[GROUP])
            df = df.join(F.broadcast(known), same)
            first = F.col("_first")
        return (
            df.select(first.alias("_first"), F.posexplode(values).alias("_at", VALUE))
            .where(F.col(VALUE).isNotNull())
            .select(
                (F.col("_first") + F.element_at(offsets, F.col("_at") + 1)).alias(SLOT),
                VALUE,
            )
        )

    def frame(
        self,
        df: DataFrame,
        rows: Mapping[tuple[Any, int], tuple],
        fields: Sequence[tuple[str, T.DataType]],
    ) -> DataFrame:
        """A small frame with the slot, class and column index of each row."""
        return self._frame(
            df,
            [(g, self.number(g, i), i, *row) for (g, i), row in rows.items()],
            [(SLOT, T.IntegerType()), (INDEX, T.IntegerType()), *fields],
        )

    def _frame(self, df, rows, fields):
        kind = T.IntegerType() if self.by is None else df.schema[self.by].dataType
        schema = [T.StructField(GROUP, kind)]
        schema += [T.StructField(name, of_type) for name, of_type in fields]
        return local_frame(df.sparkSession, rows, T.StructType(schema))


def slots_of(
    keys: Iterable[tuple[Any, int]], by: str | None, columns: Sequence[str]
) -> Slots:
    return Slots(by, tuple(dict.fromkeys(group for group, _ in keys)), len(columns))


def collect_classes(grouped: DataFrame) -> list[Row]:
    """Bring one row per (class, column) to the driver, refusing a runaway class column."""
    rows = grouped.limit(MAX_CLASS_COLUMNS + 1).collect()
    if len(rows) > MAX_CLASS_COLUMNS:
        raise ValueError(
            f"more than {MAX_CLASS_COLUMNS} class-column pairs: the label is not a class"
        )
    return rows
