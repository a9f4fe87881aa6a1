"""From monthly flight files to one event table in event order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.times import event_time_ms
from tarmac.operators.ordering import with_position
from tarmac.schema import EVENTS
from tarmac.sources.files import SOURCE


def with_event_time(monthly: DataFrame, strict: bool = True) -> DataFrame:
    return monthly.withColumn(
        "event_time",
        event_time_ms(
            F.col("YEAR"), F.col("MONTH"), F.col("DAY_OF_MONTH"), F.col("CRS_DEP_TIME"), strict
        ),
    )


def prepare_events(monthly: DataFrame, strict: bool = True) -> DataFrame:
    """The 17 event columns plus `seq`, the row's place in event order.

    Flights of the same minute keep the order of the files and of the rows in them.
    """
    ordered = with_position(with_event_time(monthly, strict), ["event_time", *SOURCE])
    return ordered.select(*EVENTS.fieldNames(), "seq")
