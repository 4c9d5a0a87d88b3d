"""Column expressions shared by the operators."""

from .columns import (
    bin_checked,
    bin_guess,
    finite,
    hash_bucket,
    name_at,
    not_nan,
    safe_ratio,
    yes_flag,
)
from .selection import categorical_columns, numeric_columns, plain

__all__ = [
    "bin_checked",
    "bin_guess",
    "categorical_columns",
    "finite",
    "hash_bucket",
    "name_at",
    "not_nan",
    "numeric_columns",
    "plain",
    "safe_ratio",
    "yes_flag",
]
