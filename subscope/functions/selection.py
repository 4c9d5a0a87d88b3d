"""Choosing columns by type from a schema."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(name: str) -> Column:
    """Reference a column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _by_type(
    df: DataFrame,
    types: tuple[type, ...],
    columns: Iterable[str] | None,
    exclude: Iterable[str],
) -> list[str]:
    excluded = set(exclude)
    matching = {f.name for f in df.schema.fields if isinstance(f.dataType, types)}
    wanted = df.columns if columns is None else list(dict.fromkeys(columns))
    return [c for c in wanted if c in matching and c not in excluded]


def numeric_columns(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    exclude: Iterable[str] = (),
) -> list[str]:
    """Numeric columns in schema order, or the numeric ones among ``columns``.

    Unknown names and names of other types are left out without an error.
    """
    return _by_type(df, (T.NumericType,), columns, exclude)


def categorical_columns(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    exclude: Iterable[str] = (),
) -> list[str]:
    """String and boolean columns, chosen like :func:`numeric_columns`."""
    return _by_type(df, (T.StringType, T.BooleanType), columns, exclude)
