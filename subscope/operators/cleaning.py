"""Flag encoding, mean imputation and three-sigma capping.

Fitting reads the table once, whatever the number of columns, and brings back one row
per column.
The fitted model holds plain numbers, so it is a narrow projection on any later frame:
the same table, a held-out part or a stream.
"""

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric_columns, plain, yes_flag
from ..schemas import FLAGS, LABEL
from ..sources.local import local_frame
from .profile import column_stats


def binarize(df: DataFrame, columns: Sequence[str] = FLAGS) -> DataFrame:
    """Turn yes/no text into 1/0 in place."""
    return df.withColumns({c: yes_flag(plain(c)) for c in columns})


@dataclass(frozen=True)
class ColumnBounds:
    """What one column was fitted to; a part is None when it is undefined."""

    column: str
    mean: float | None
    lower: float | None
    upper: float | None


def _known(value: float | None) -> float | None:
    return value if value is not None and math.isfinite(value) else None


class SigmaCapper:
    """Estimator of mean and mean ± ``sigmas`` sample standard deviations per column.

    ``columns=None`` takes every numeric column except the label; ``include_label=True``
    treats the label like the others. NaN and infinities do not enter the statistics.
    """

    def __init__(
        self,
        columns: Iterable[str] | None = None,
        exclude: Iterable[str] = (),
        sigmas: float = 3.0,
        label: str = LABEL,
        include_label: bool = False,
    ):
        self.columns = None if columns is None else list(columns)
        self.exclude = set(exclude) | (set() if include_label else {label})
        self.sigmas = sigmas

    def fit(self, df: DataFrame) -> "SigmaCapModel":
        columns = numeric_columns(df, self.columns, self.exclude)
        if not columns:
            return SigmaCapModel([])
        stats = {r["column"]: r for r in column_stats(df, columns).collect()}
        bounds = []
        for c in columns:
            row = stats.get(c)
            bounds.append(self.of_moments(c, row and row["mean"], row and row["std"]))
        return SigmaCapModel(bounds)

    def of_moments(self, column: str, mean: float | None, std: float | None) -> ColumnBounds:
        """The bounds of a column whose mean and deviation are known."""
        return self._bounds(column, _known(mean), _known(std))

    def _bounds(
        self, column: str, mean: float | None, std: float | None
    ) -> ColumnBounds:
        if mean is None or std is None:
            return ColumnBounds(column, mean, None, None)
        reach = self.sigmas * std
        return ColumnBounds(column, mean, _known(mean - reach), _known(mean + reach))


class SigmaCapModel:
    """Fitted bounds; ``impute`` and ``transform`` are projections without a shuffle."""

    def __init__(self, bounds: Sequence[ColumnBounds]):
        self.bounds = list(bounds)

    def impute(self, df: DataFrame) -> DataFrame:
        """Only replace missing values by the mean."""
        return df.withColumns({b.column: self._imputed(b) for b in self.bounds})

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace missing values by the mean and pull outliers to the bounds."""
        return df.withColumns({b.column: self._capped(b) for b in self.bounds})

    @staticmethod
    def _imputed(b: ColumnBounds):
        value = plain(b.column).cast("double")
        missing = value.isNull() | F.isnan(value)
        return F.when(missing, F.lit(b.mean).cast("double")).otherwise(value)

    @classmethod
    def _capped(cls, b: ColumnBounds):
        value = plain(b.column).cast("double")
        missing = value.isNull() | F.isnan(value)
        capped = F.when(missing, F.lit(b.mean).cast("double"))
        if b.upper is not None:
            capped = capped.when(value > b.upper, F.lit(b.upper))
        if b.lower is not None:
            capped = capped.when(value < b.lower, F.lit(b.lower))
        return capped.otherwise(value)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the bounds, one row per column."""
        rows = [(b.column, b.mean, b.lower, b.upper) for b in self.bounds]
        frame = local_frame(
            spark, rows, "column string, mean double, lower double, upper double"
        )
        frame.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SigmaCapModel":
        rows = spark.read.parquet(path).select("column", "mean", "lower", "upper")
        return cls([ColumnBounds(*row) for row in rows.collect()])


def clean(
    df: DataFrame, flags: Sequence[str] = FLAGS, capper: SigmaCapper | None = None
) -> tuple[DataFrame, SigmaCapModel]:
    """Encode flags, fit the capper on the result and apply it."""
    encoded = binarize(df, flags)
    model = (capper or SigmaCapper()).fit(encoded)
    return model.transform(encoded), model
