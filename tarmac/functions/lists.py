"""Delayed-flight lists: arrays of (place, carrier, dest, dep_delay, minutes) and their text.

`minutes` is the delay as two-decimal text, made while the flights are still rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.numbers import two_decimals


def gather(worst: DataFrame, keys: list[str]) -> DataFrame:
    """One array per key, ordered by place; the rows must be trimmed to a short list already."""
    flight = F.struct("place", "carrier", "dest", "dep_delay", "minutes")
    return (
        worst.withColumn("minutes", two_decimals("dep_delay"))
        .groupBy(*keys).agg(F.sort_array(F.collect_list(flight)).alias("delayed"))
    )


def _parts(flight: Column) -> list[Column]:
    """Carrier, destination and minutes as text; a missing one is empty, so none shifts or drops."""
    texts = (flight["carrier"], flight["dest"].cast("string"), flight["minutes"])
    return [F.coalesce(text, F.lit("")) for text in texts]


def bracketed(flights: Column) -> Column:
    """`[(AA,13303,1766.00), (DL,10397,90.00)]`, and `[]` when there are none."""
    items = F.transform(
        flights, lambda f: F.concat(F.lit("("), F.concat_ws(",", *_parts(f)), F.lit(")"))
    )
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def piped(flights: Column) -> Column:
    """`AA|13303|1766.00;DL|10397|90.00`, and empty text when there are none."""
    items = F.transform(flights, lambda f: F.concat_ws("|", *_parts(f)))
    return F.array_join(items, ";")
