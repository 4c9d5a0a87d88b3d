"""Usage features derived row by row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import safe_ratio


def add_totals(df: DataFrame) -> DataFrame:
    """Totals over the day, evening and night periods.

    International use enters the charge only, not the minutes or the calls.
    """
    return df.withColumns(
        {
            "total_minutes": F.col("total_day_minutes")
            + F.col("total_eve_minutes")
            + F.col("total_night_minutes"),
            "total_calls": F.col("total_day_calls")
            + F.col("total_eve_calls")
            + F.col("total_night_calls"),
            "total_charge": F.col("total_day_charge")
            + F.col("total_eve_charge")
            + F.col("total_night_charge")
            + F.col("total_intl_charge"),
        }
    )


def add_ratios(df: DataFrame) -> DataFrame:
    """Minutes per call (0 without calls) and the daytime share (NULL without minutes)."""
    return df.withColumns(
        {
            "avg_minutes_per_call": F.when(
                F.col("total_calls") > 0,
                safe_ratio(F.col("total_minutes"), F.col("total_calls")),
            ).otherwise(F.lit(0.0)),
            "daytime_ratio": safe_ratio(
                F.col("total_day_minutes"), F.col("total_minutes")
            ),
        }
    )


def add_features(df: DataFrame) -> DataFrame:
    return add_ratios(add_totals(df))
