"""Airport reports from stored pre-aggregates plus the event file."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.lists import bracketed
from tarmac.operators.airports import preagg_stats, rank_airports, ranking_report, roll_up
from tarmac.operators.intervals import interval_join
from tarmac.operators.worst import attach_lists, delayed_lists, worst_flights
from tarmac.plans.airports import severe_flights
from tarmac.session import settle
from tarmac.settings import DEFAULTS, Settings

KEYS = ("ws", "we", "origin")


def ranking_from_preagg(
    preagg: DataFrame, whole: bool = False, settings: Settings = DEFAULTS
) -> DataFrame:
    """Ranked airports per window, or over the span of all windows; equal ones by airport id."""
    stats = preagg_stats(preagg)
    return rank_airports(roll_up(stats) if whole else stats, settings, ties="airport")


def flights_in_windows(
    flights: DataFrame, windows: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Severe flights of each (window, airport) in `windows`, which must be settled."""
    return interval_join(
        severe_flights(flights, settings), windows.select(*KEYS), key="origin"
    )


def report_from_preagg(
    preagg: DataFrame, flights: DataFrame, whole: bool = False, settings: Settings = DEFAULTS,
    ties: str = "key_desc",
) -> DataFrame:
    """The full report; its lists come from one pass over the events for all windows at once."""
    return fill_lists(
        settle(ranking_from_preagg(preagg, whole, settings)), flights, settings, ties
    )


def reports_from_preagg(
    sources: dict[str, tuple[DataFrame, bool, Settings]], flights: DataFrame,
    settings: Settings = DEFAULTS, ties: str = "key_desc",
) -> DataFrame:
    """Several reports, told apart by `report`, whose lists come from one pass over the events.

    `sources` has for each its pre-aggregates, whether they are rolled up to the span of all windows,
    and the settings of its ranking.
    """
    ranked = functools.reduce(DataFrame.unionByName, [
        ranking_from_preagg(preagg, whole, own).withColumn("report", F.lit(name))
        for name, (preagg, whole, own) in sources.items()
    ])
    return fill_lists(settle(ranked), flights, settings, ties, ("report",))


def fill_lists(
    ranked: DataFrame, flights: DataFrame, settings: Settings = DEFAULTS, ties: str = "key_desc",
    more: tuple[str, ...] = (),
) -> DataFrame:
    """The ranked rows with their lists; `more` names columns that tell windows apart besides KEYS."""
    keys = (*more, *KEYS)
    found = interval_join(severe_flights(flights, settings), ranked.select(*keys), key="origin")
    worst = worst_flights(found, settings, ties, keys)
    filled = attach_lists(ranked, delayed_lists(worst, keys), keys)
    return ranking_report(filled, bracketed(F.col("delayed")).alias("delayed_flights"), *map(F.col, more))
