"""Small column expressions. All of them stay inside whole-stage code generation."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .selection import plain


def yes_flag(column: Column, yes: str = "yes") -> Column:
    """1 for exactly ``yes``, 0 for everything else, NULL included."""
    return F.when(column == yes, 1).otherwise(0)


def not_nan(column: Column) -> Column:
    """The value as a double; NULL for NaN."""
    value = column.cast("double")
    return F.when(~F.isnan(value), value)


def finite(column: Column) -> Column:
    """The value as a double; NULL for NaN and infinities (NaN sorts above infinity)."""
    value = column.cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL on a zero denominator, with ANSI mode on or off."""
    return F.try_divide(numerator, denominator)


def name_at(names: Sequence[str], index: Column) -> Column:
    """The name at a zero-based position of a short, fixed list."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), index + 1)


def bin_guess(value: Column, low: Column, width: Column, bins: Column) -> Column:
    """Equal-width bin by division; see :func:`bin_checked` for values on an edge."""
    return F.least(F.floor((value - low) / width), bins - 1)


def bin_checked(
    guess: Column, value: Column, low: Column, width: Column, bins: Column
) -> Column:
    """Bin 0..bins-1 with ``low + i*width <= value < low + (i+1)*width``.

    The last bin is closed. The quotient can be one off where a value sits on an edge,
    so the guess is checked against the edges themselves.
    """
    return (
        F.when(value < low + guess * width, guess - 1)
        .when((guess < bins - 1) & (value >= low + (guess + 1) * width), guess + 1)
        .otherwise(guess)
        .cast("long")
    )


def hash_bucket(
    key: str, columns: Sequence[str], buckets: int, seed: int = 42
) -> Column:
    """Bucket 0..buckets-1 that depends on the row alone, never on its partition.

    Rows without a key are spread by a hash over all ``columns`` so that a large NULL
    group does not fall into one bucket.
    """
    by_key = F.xxhash64(F.lit(seed), plain(key))
    by_row = F.xxhash64(F.lit(seed), *[plain(c) for c in columns])
    chosen = F.when(plain(key).isNotNull(), by_key).otherwise(by_row)
    return F.pmod(chosen, F.lit(buckets)).cast("int")
