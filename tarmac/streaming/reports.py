"""The reports over unbounded event lines: same measures, event-time windows, append mode.

Each (window, key) comes out once, when the watermark passes the window's end; rows that arrive
after that are dropped. State holds one row of sums per open (window, key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.times import timestamp
from tarmac.operators.airports import airport_measures
from tarmac.operators.carriers import carrier_measures, carrier_report
from tarmac.settings import DEFAULTS, HOUR_MS, Settings
from tarmac.sources.lines import parse_airport_flights, parse_carrier_flights


def in_event_time(flights: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Event time from the event_time field, with the watermark on what the filters left."""
    return flights.withColumn("ts", timestamp(F.col("event_time"))).withWatermark(
        "ts", settings.watermark
    )


def tumbling(step_ms: int):
    return F.window("ts", f"{step_ms // 1000} seconds")


def _with_bounds(measured: DataFrame) -> DataFrame:
    return measured.withColumn("ws", F.unix_millis("window.start")).withColumn(
        "we", F.unix_millis("window.end")
    )


def carrier_stream(
    lines: DataFrame, settings: Settings = DEFAULTS, step_ms: int = HOUR_MS
) -> DataFrame:
    """Carrier statistics per window.

    The end line's own window never closes, so its row never comes out. Filtering it away here
    would be undone by the optimizer: a filter on the key moves below the watermark.
    """
    flights = in_event_time(parse_carrier_flights(lines, settings, keep_end=True), settings)
    measured = flights.groupBy(tumbling(step_ms), "carrier").agg(*carrier_measures(settings))
    return carrier_report(_with_bounds(measured))


def airport_stream(lines: DataFrame, step_ms: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Airport statistics per window, in the columns of the batch ones."""
    flights = in_event_time(parse_airport_flights(lines, keep_end=True), settings)
    measured = flights.groupBy(tumbling(step_ms), "origin").agg(*airport_measures(settings))
    return _with_bounds(measured).select(
        "ws", "we", "origin", "num", "severe", "sum_delay", "max_delay", "first_seq"
    )
