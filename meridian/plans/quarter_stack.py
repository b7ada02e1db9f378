"""The flagship plan: flag, take out each series' median, stack the days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.operators.aggregates import sidereal_mean, stack_days, subtract_mean
from meridian.operators.masks import apply_data_flags

SERIES = ["lsd", "freq_id", "stack_id"]


def quarter_stack(day: DataFrame, flags: DataFrame, types: list[str], last_ra: int, missing: float = 0.3, width: float = 86400.0) -> DataFrame:
    flagged = apply_data_flags(day, flags, types, width)
    mean = sidereal_mean(flagged, SERIES, F.col("ra_id") <= last_ra, True, missing)
    return stack_days(subtract_mean(flagged, mean, SERIES), ["freq_id", "stack_id", "ra_id"])
