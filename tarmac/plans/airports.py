"""Airport reports straight from the flights: rankings and the flights behind them.

`step_ms` is the window length; None is one window over the whole dataset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.lists import bracketed, piped
from tarmac.functions.times import stamp
from tarmac.operators.airports import (
    airport_stats,
    in_spans,
    preagg_report,
    rank_airports,
    ranking_report,
    stats_for_spans,
    with_bounds,
    with_window,
)
from tarmac.operators.flights import flown, is_severe
from tarmac.operators.worst import attach_lists, delayed_lists, of_winners, worst_flights
from tarmac.session import settle
from tarmac.settings import DEFAULTS, Settings


def severe_flights(flights: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The threshold goes first: it also rules out blank delays and can reach the scan."""
    return flown(flights.where(is_severe(settings) & F.col("origin").isNotNull()))


def airport_ranking(
    flights: DataFrame, step_ms: int | None, settings: Settings = DEFAULTS
) -> DataFrame:
    return ranking_report(rank_airports(airport_stats(flown(flights), step_ms, settings), settings))


def _winners_and_worst(flights: DataFrame, step_ms: int | None, settings: Settings):
    """Ranked airports, their worst flights, and the columns that link the two.

    The ranking is read twice (as a filter on the flights, and as the rows to fill), so it is
    settled: two passes over the events in all, one per half.
    """
    ranked = settle(rank_airports(airport_stats(flown(flights), step_ms, settings), settings))
    severe = severe_flights(flights, settings)
    if step_ms is None:
        keys = ["origin"]
    else:
        severe, keys = with_window(severe, step_ms), ["ws", "origin"]
    worst = worst_flights(of_winners(severe, ranked, keys), settings, keys=keys)
    return ranked, worst, keys


def delayed_flights(
    flights: DataFrame, step_ms: int | None, settings: Settings = DEFAULTS
) -> DataFrame:
    """One row per listed flight of each ranked airport."""
    ranked, worst, keys = _winners_and_worst(flights, step_ms, settings)
    return ranked.join(worst.select(*keys, "place", "carrier", "dest", "dep_delay"), keys).select(
        stamp(F.col("ws")).alias("ts"),
        "rank",
        F.col("origin").alias("origin_airport_id"),
        "place", "carrier", "dest", "dep_delay",
    )


def airport_report(
    flights: DataFrame, step_ms: int | None, settings: Settings = DEFAULTS
) -> DataFrame:
    """The full report: ranked airports, each with the text list of its worst flights."""
    ranked, worst, keys = _winners_and_worst(flights, step_ms, settings)
    filled = attach_lists(ranked, delayed_lists(worst, keys), keys)
    return ranking_report(filled, bracketed(F.col("delayed")).alias("delayed_flights"))


def airport_reports(
    flights: DataFrame, spans: dict[str, int | None], settings: Settings = DEFAULTS,
    min_flights: dict[str, int] | None = None,
) -> DataFrame:
    """The full reports of several windows, told apart by `span`.

    Two passes over the events whatever the number of windows: one for the statistics of the
    shortest window, which the others add up, and one for the flights behind the ranks.
    """
    least = None
    if min_flights:
        pairs = [F.lit(x) for pair in min_flights.items() for x in pair]
        least = F.coalesce(F.create_map(*pairs)[F.col("span")], F.lit(settings.min_flights))
    keys = ["span", "slot", "origin"]
    stats = settle(stats_for_spans(flown(flights), spans, settings))
    ranked = rank_airports(stats, settings, window=("span", "slot"), min_flights=least)
    ranked = settle(with_bounds(ranked, stats, spans))
    severe = severe_flights(flights, settings)
    severe = severe.withColumn("s", F.explode(in_spans(F.col("event_time"), spans))).select(
        *severe.columns, "s.span", "s.slot"
    )
    worst = worst_flights(of_winners(severe, ranked, keys), settings, keys=keys)
    filled = attach_lists(ranked, delayed_lists(worst, keys), keys)
    return ranking_report(filled, bracketed(F.col("delayed")).alias("delayed_flights"), "span")


def airport_lists(flights: DataFrame, step_ms: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Every (window, airport) with flights, unranked, each with the array of its worst flights."""
    keys = ["ws", "origin"]
    worst = worst_flights(
        with_window(severe_flights(flights, settings), step_ms), settings, keys=keys
    )
    stats = airport_stats(flown(flights), step_ms, settings)
    return attach_lists(stats, delayed_lists(worst, keys), keys)


def airport_preagg(flights: DataFrame, step_ms: int, settings: Settings = DEFAULTS) -> DataFrame:
    """The per-(window, airport) pre-aggregate: seven plain columns."""
    return preagg_report(airport_stats(flown(flights), step_ms, settings))


def airport_preagg_lists(
    flights: DataFrame, step_ms: int, settings: Settings = DEFAULTS
) -> DataFrame:
    """The pre-aggregate with the text list of each airport's worst flights in the window."""
    filled = airport_lists(flights, step_ms, settings)
    return preagg_report(filled, piped(F.col("delayed")).alias("top_str"))
