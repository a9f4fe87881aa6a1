"""Column layouts of the event file and of the reports."""

from __future__ import annotations

from pyspark.sql import types as T

# Names, order and types of the event columns.
MONTHLY = T.StructType(
    [
        T.StructField("YEAR", T.IntegerType()),
        T.StructField("MONTH", T.IntegerType()),
        T.StructField("DAY_OF_MONTH", T.IntegerType()),
        T.StructField("OP_UNIQUE_CARRIER", T.StringType()),
        T.StructField("ORIGIN_AIRPORT_ID", T.IntegerType()),
        T.StructField("DEST_AIRPORT_ID", T.IntegerType()),
        T.StructField("CRS_DEP_TIME", T.IntegerType()),
        T.StructField("DEP_DELAY", T.DoubleType()),
        T.StructField("ARR_DELAY", T.DoubleType()),
        T.StructField("CANCELLED", T.DoubleType()),
        T.StructField("DIVERTED", T.DoubleType()),
        T.StructField("CARRIER_DELAY", T.DoubleType()),
        T.StructField("WEATHER_DELAY", T.DoubleType()),
        T.StructField("NAS_DELAY", T.DoubleType()),
        T.StructField("SECURITY_DELAY", T.DoubleType()),
        T.StructField("LATE_AIRCRAFT_DELAY", T.DoubleType()),
    ]
)
EVENTS = T.StructType([*MONTHLY.fields, T.StructField("event_time", T.LongType())])

# Event column -> name used by the operators. `seq` is the flight's place in the event-ordered
# stream: unique, growing with event_time, and the tie-break wherever arrival order counts.
FLIGHT_COLUMNS = {
    "OP_UNIQUE_CARRIER": "carrier",
    "ORIGIN_AIRPORT_ID": "origin",
    "DEST_AIRPORT_ID": "dest",
    "DEP_DELAY": "dep_delay",
    "CANCELLED": "cancelled",
    "DIVERTED": "diverted",
    "event_time": "event_time",
}

PREAGG = T.StructType(
    [
        T.StructField("window_start", T.StringType()),
        T.StructField("window_end", T.StringType()),
        T.StructField("airport_id", T.IntegerType()),
        T.StructField("num", T.LongType()),
        T.StructField("severe", T.LongType()),
        T.StructField("sum_delay", T.DoubleType()),
        T.StructField("max_delay", T.DoubleType()),
    ]
)
