"""Row-level flight predicates and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.numbers import number_or_zero
from tarmac.settings import DEFAULTS, Settings


def _above(delay: Column, minutes: float) -> Column:
    """Strictly above; NaN, which Spark orders last, is not above anything."""
    return (delay > minutes) & ~F.isnan(delay)


def is_severe(settings: Settings = DEFAULTS) -> Column:
    return _above(F.col("dep_delay"), settings.severe_minutes)


def is_late(settings: Settings = DEFAULTS) -> Column:
    return _above(F.col("dep_delay"), settings.late_minutes)


def is_cancelled() -> Column:
    return F.coalesce(F.col("cancelled") >= 1.0, F.lit(False))


def is_diverted() -> Column:
    return F.coalesce(F.col("diverted") >= 1.0, F.lit(False))


def delay_or_zero(flights: DataFrame) -> DataFrame:
    """A blank delay is 0.0 and counts in every mean."""
    return flights.withColumn("dep_delay", F.coalesce("dep_delay", F.lit(0.0)))


def of_carriers(flights: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return flights.where(F.col("carrier").isin(list(settings.carriers)))


def flown(flights: DataFrame, blank_flags: str = "keep") -> DataFrame:
    """Flights neither cancelled nor diverted, with blank delays as 0.0.

    A blank flag counts as not set; blank_flags="drop" leaves such flights out instead.
    """
    def unset(name: str) -> Column:
        below = F.col(name) < 1.0
        return below if blank_flags == "drop" else F.col(name).isNull() | below

    kept = flights.where(unset("cancelled") & unset("diverted"))
    return kept.withColumn("dep_delay", number_or_zero(F.col("dep_delay"))).drop(
        "cancelled", "diverted"
    )
