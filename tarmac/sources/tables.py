"""Flights derived from the `events` table of the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schema import EVENTS, MONTHLY
from tarmac.session import use_utc

# Fixed values of the projection (the SQL checks use the same ones).
CARRIERS = ("AA", "DL", "UA", "WN", "B6", "OO")


def table_flights(spark: SparkSession, directory: str) -> DataFrame:
    """Each event as one flight: seq, event_time, carrier, airports, delay and flags."""
    use_utc(spark)
    k = F.col("k")
    events = spark.read.parquet(f"{directory}/events.parquet").select(
        F.col("event_id").alias("seq"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time"),
        "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    cancelled = (F.col("event_type") == "error") & (k % 4 == 0)
    diverted = (F.col("event_type") == "view") & (k % 10 == 0)
    return events.select(
        "seq",
        "event_time",
        F.element_at(F.array(*[F.lit(c) for c in CARRIERS]), k % len(CARRIERS) + 1).alias(
            "carrier"
        ),
        (F.col("user_id") % 40 + 10001).cast("int").alias("origin"),
        (F.col("seq") % 20 + 20001).cast("int").alias("dest"),
        F.when(~(cancelled | (k == 7)), F.floor("value").cast("double") - 20.0).alias("dep_delay"),
        F.when(cancelled, 1.0).otherwise(0.0).alias("cancelled"),
        F.when(diverted, 1.0).otherwise(0.0).alias("diverted"),
    )


def table_monthly(flights: DataFrame) -> DataFrame:
    """The same flights in the layout of the monthly files, with `seq` kept beside it.

    Scheduled time is cut to the minute. Of the carried columns, the arrival delay is five
    minutes below the departure delay and the late-aircraft delay repeats a departure delay
    above 15; the other causes are blank.
    """
    at = F.timestamp_millis("event_time")
    delay = F.col("dep_delay")
    blank = F.lit(None).cast("double")
    columns = {
        "YEAR": F.year(at),
        "MONTH": F.month(at),
        "DAY_OF_MONTH": F.dayofmonth(at),
        "OP_UNIQUE_CARRIER": F.col("carrier"),
        "ORIGIN_AIRPORT_ID": F.col("origin"),
        "DEST_AIRPORT_ID": F.col("dest"),
        "CRS_DEP_TIME": F.hour(at) * 100 + F.minute(at),
        "DEP_DELAY": delay,
        "ARR_DELAY": delay - 5.0,
        "CANCELLED": F.col("cancelled"),
        "DIVERTED": F.col("diverted"),
        "LATE_AIRCRAFT_DELAY": F.when(delay > 15.0, delay),
    }
    return flights.select(
        *[columns.get(name, blank).alias(name) for name in MONTHLY.fieldNames()],
        "seq", "event_time",
    )


def damaged_lines(flights: DataFrame) -> DataFrame:
    """The flights as event lines, with the lines of some destinations damaged in one way each.

    20002 an unreadable delay, 20003 one field short, 20004 more fields than needed, 20005 a
    fractional airport id, 20006 a blank cancellation flag, 20007 blanks around the line,
    20008 a fractional event time, 20009 blanks around the delay, 20010 a Java-only number.
    """
    names = EVENTS.fieldNames()
    texts = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names}
    dest = F.col("DEST_AIRPORT_ID")

    def damage(where: int, name: str, text) -> None:
        texts[name] = F.when(dest == where, text).otherwise(texts[name])

    delay, time = texts["DEP_DELAY"], texts["event_time"]
    damage(20002, "DEP_DELAY", F.lit("abc"))
    damage(20005, "ORIGIN_AIRPORT_ID", F.concat(texts["ORIGIN_AIRPORT_ID"], F.lit(".0")))
    damage(20006, "CANCELLED", F.lit(""))
    damage(20008, "event_time", F.concat(time, F.lit(".0")))
    damage(20009, "DEP_DELAY", F.concat(F.lit(" "), delay, F.lit("\t")))
    damage(20010, "DEP_DELAY", F.concat(delay, F.lit("d")))
    fields = F.array(*[texts[name] for name in names], F.col("seq").cast("string"))
    line = F.array_join(
        F.when(dest == 20003, F.slice(fields, 1, len(names) - 1))
        .when(dest == 20004, F.concat(fields, F.array(F.lit("more"), F.lit(""))))
        .otherwise(fields),
        ",",
    )
    line = F.when(dest == 20007, F.concat(F.lit("  "), line, F.lit("\r"))).otherwise(line)
    return table_monthly(flights).select(line.alias("value"))
