"""Hourly statistics per carrier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.numbers import percent, ratio, two_decimals
from tarmac.functions.times import bucket_start, stamp
from tarmac.operators.flights import delay_or_zero, is_cancelled, is_diverted, is_late, of_carriers
from tarmac.settings import DEFAULTS, HOUR_MS, Settings


def carrier_measures(settings: Settings = DEFAULTS) -> list[Column]:
    """Sums and counts that merge, so partial results form before the shuffle."""
    cancelled, diverted = is_cancelled(), is_diverted()
    return [
        F.count("*").alias("num_flights"),
        F.count_if(~cancelled & ~diverted).alias("completed"),
        F.count_if(cancelled).alias("cancelled"),
        F.count_if(diverted).alias("diverted"),
        F.sum(F.when(~cancelled, F.col("dep_delay")).otherwise(0.0)).alias("delay_sum"),
        F.count_if(~cancelled).alias("departed"),
        F.count_if(~cancelled & is_late(settings)).alias("late"),
    ]


def carrier_report(measured: DataFrame) -> DataFrame:
    """Means and rates from the measures; expects ws and we in milliseconds."""
    return measured.select(
        stamp(F.col("ws")).alias("window_start"),
        stamp(F.col("we")).alias("window_end"),
        F.col("carrier").alias("airline"),
        "num_flights", "completed", "cancelled", "diverted",
        ratio(F.col("delay_sum"), F.col("departed")).alias("dep_delay_mean"),
        percent(F.col("cancelled"), F.col("num_flights")).alias("cancellation_rate"),
        percent(F.col("late"), F.col("departed")).alias("late_departure_rate"),
    )


def hourly_carrier_stats(
    flights: DataFrame, settings: Settings = DEFAULTS, step_ms: int = HOUR_MS
) -> DataFrame:
    flights = delay_or_zero(of_carriers(flights, settings))
    measured = (
        flights.withColumn("ws", bucket_start(F.col("event_time"), step_ms))
        .groupBy("ws", "carrier")
        .agg(*carrier_measures(settings))
        .withColumn("we", F.col("ws") + F.lit(step_ms).cast("bigint"))
    )
    return carrier_report(measured)


def carrier_text(report: DataFrame) -> DataFrame:
    """The report as published: means and rates as two-decimal text."""
    rounded = ("dep_delay_mean", "cancellation_rate", "late_departure_rate")
    return report.withColumns({name: two_decimals(name) for name in rounded})
