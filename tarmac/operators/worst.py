"""The worst delayed flights of each (window, airport)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.lists import gather
from tarmac.session import fits_broadcast
from tarmac.settings import DEFAULTS, Settings

KEYS = ("ws", "we", "origin")
SHARES = 64


def _order(ties: str) -> list[Column]:
    """Longest delay first; equal ones by arrival, or by carrier and destination downwards."""
    if ties == "arrival":
        return [F.desc("dep_delay"), F.asc_nulls_last("seq"), F.asc("event_time")]
    return [F.desc("dep_delay"), F.desc("carrier"), F.desc("dest")]


def worst_flights(
    severe: DataFrame, settings: Settings = DEFAULTS, ties: str = "arrival", keys=KEYS
) -> DataFrame:
    """The first `list_length` flights per key, with their `place` in the list.

    Two steps, so that no key has to fit one task: every scan task first keeps its own best,
    groups of tasks (`share`) merge theirs, and the last step sees at most SHARES short lists per
    key. Any way of sharing out the rows gives the same result.
    """
    keys = list(keys)
    order = _order(ties)
    shared = severe.withColumn("share", F.spark_partition_id() % F.lit(SHARES))
    first = Window.partitionBy(*keys, "share").orderBy(*order)
    last = Window.partitionBy(*keys).orderBy(*order)
    candidates = (
        shared.withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= settings.list_length)
        .drop("place", "share")
    )
    return candidates.withColumn("place", F.row_number().over(last)).where(
        F.col("place") <= settings.list_length
    )


def of_winners(severe: DataFrame, winners: DataFrame, keys=("ws", "origin")) -> DataFrame:
    """Left semi join of the flights with the ranked (window, airport) pairs.

    `winners` must be settled. Up to the broadcast bound every executor gets the pairs; past it
    both sides are shuffled, and adaptive execution splits the keys of busy airports.
    """
    pairs = winners.select(*keys)
    pairs = F.broadcast(pairs) if fits_broadcast(pairs) else pairs
    return severe.join(pairs, list(keys), "left_semi")


def delayed_lists(worst: DataFrame, keys=KEYS) -> DataFrame:
    """One array per key; the rows are already limited to `list_length` each."""
    return gather(worst, list(keys))


def attach_lists(rows: DataFrame, lists: DataFrame, keys=KEYS) -> DataFrame:
    """Left outer join; a key without delayed flights gets an empty list."""
    joined = rows.join(lists, list(keys), "left")
    empty = F.array().cast(lists.schema["delayed"].dataType)
    return joined.withColumn("delayed", F.coalesce("delayed", empty))
