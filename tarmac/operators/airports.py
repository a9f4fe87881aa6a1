"""Per-airport delay statistics over time windows, and the ranking of airports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.numbers import ratio
from tarmac.functions.times import bucket_start, stamp, stamp_to_ms
from tarmac.operators.flights import is_severe
from tarmac.settings import DEFAULTS, Settings


def airport_measures(settings: Settings = DEFAULTS) -> list[Column]:
    """All of them fixed-width, so the grouping stays a hash aggregate with partials."""
    delay = F.col("dep_delay")
    return [
        F.count("*").alias("num"),
        F.count_if(is_severe(settings)).alias("severe"),
        F.sum(delay).alias("sum_delay"),
        F.max(F.when(~F.isnan(delay), delay)).alias("max_delay"),  # NULL if none is a number
        F.min("seq").alias("first_seq"),
    ]


def with_window(flights: DataFrame, step_ms: int) -> DataFrame:
    """Add the bounds [ws, we) of the tumbling window each flight falls in."""
    start = bucket_start(F.col("event_time"), step_ms)
    return flights.withColumn("ws", start).withColumn(
        "we", F.col("ws") + F.lit(step_ms).cast("bigint")
    )


def airport_stats(
    flights: DataFrame, step_ms: int | None, settings: Settings = DEFAULTS
) -> DataFrame:
    """One row per (window, airport) of flown flights; step None is one window over all of them.

    Flights without an airport count nowhere.
    The whole-dataset window runs from the first flight to just after the last. Its bounds are
    taken from the airports' own first and last flights, so the events are read once and only
    one row per airport meets in the last step.
    """
    flights = flights.where(F.col("origin").isNotNull())
    if step_ms is not None:
        stats = (
            flights.withColumn("ws", bucket_start(F.col("event_time"), step_ms))
            .groupBy("ws", "origin").agg(*airport_measures(settings))
            .withColumn("we", F.col("ws") + F.lit(step_ms).cast("bigint"))
        )
    else:
        per_airport = flights.groupBy("origin").agg(
            *airport_measures(settings),
            F.min("event_time").alias("first_ms"),
            F.max("event_time").alias("last_ms"),
        ).withColumn("whole", F.lit(0))
        whole = Window.partitionBy("whole")
        stats = per_airport.withColumns(
            {
                "ws": F.min("first_ms").over(whole),
                "we": F.max("last_ms").over(whole) + F.lit(1).cast("bigint"),
            }
        )
    return stats.select(
        "ws", "we", "origin", "num", "severe", "sum_delay", "max_delay", "first_seq"
    )


def stats_for_spans(
    flights: DataFrame, spans: dict[str, int | None], settings: Settings = DEFAULTS
) -> DataFrame:
    """airport_stats of several window lengths at once, from one pass over the events.

    The shortest window is aggregated from the flights; the longer ones, which must be multiples
    of it, and the whole dataset (None) add up its rows. `slot` is the window's start, or 0 for
    the whole dataset. `first_ms` and `last_ms` are the airport's own; see with_bounds.
    """
    base = min(step for step in spans.values() if step is not None)
    if any(step is not None and step % base for step in spans.values()):
        raise ValueError("longer windows must be multiples of the shortest")
    hours = (
        flights.where(F.col("origin").isNotNull()).withColumn("slot", bucket_start(F.col("event_time"), base))
        .groupBy("slot", "origin")
        .agg(
            *airport_measures(settings),
            F.min("event_time").alias("first_ms"),
            F.max("event_time").alias("last_ms"),
        )
    )
    added = hours.withColumn("s", F.explode(in_spans(F.col("slot"), spans))).groupBy(
        "s.span", "s.slot", "origin"
    ).agg(
        *[F.sum(n).alias(n) for n in ("num", "severe", "sum_delay")],
        F.max("max_delay").alias("max_delay"),
        *[F.min(n).alias(n) for n in ("first_seq", "first_ms")],
        F.max("last_ms").alias("last_ms"),
    )
    return added


def with_bounds(ranked: DataFrame, stats: DataFrame, spans: dict[str, int | None]) -> DataFrame:
    """Rows of stats_for_spans with the bounds [ws, we) of their windows.

    Attached to the few rows that a ranking has left. Fixed windows follow from their slot; the whole
    dataset runs from the first flight of all airports in `stats` to just after the last, which are
    one row for each such span, summed up before they meet.
    """
    whole = [name for name, step in spans.items() if step is None]
    steps = F.create_map(*[F.lit(x) for name, step in spans.items() if step for x in (name, step)])
    if whole:
        ends = stats.where(F.col("span").isin(whole)).groupBy("span", "slot").agg(
            F.min("first_ms").alias("from_ms"), F.max("last_ms").alias("to_ms")
        )
        ranked = ranked.join(F.broadcast(ends), ["span", "slot"], "left")
    else:
        ranked = ranked.withColumns({n: F.lit(None).cast("bigint") for n in ("from_ms", "to_ms")})
    end = F.coalesce(F.col("slot") + steps[F.col("span")].cast("bigint"), F.col("to_ms") + 1)
    return ranked.withColumns({"ws": F.coalesce("from_ms", "slot"), "we": end}).drop(
        "first_ms", "last_ms", "from_ms", "to_ms"
    )


def in_spans(ms: Column, spans: dict[str, int | None]) -> Column:
    """The (span, slot) pairs a point in time belongs to, one per span."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("span"),
                (F.lit(0).cast("bigint") if step is None else bucket_start(ms, step)).alias("slot"),
            )
            for name, step in spans.items()
        ]
    )


def rank_airports(
    stats: DataFrame, settings: Settings = DEFAULTS, ties: str = "arrival",
    window=("ws", "we"), min_flights: Column | None = None,
) -> DataFrame:
    """The top airports of each window: most severe delays first, then most flights.

    Equal airports rank by their first flight in the stream ("arrival") or by id ("airport").
    Windows hold one row per airport. Where the rows are not yet dealt out by window, the rank limit
    is applied before that shuffle too.
    `min_flights` may set the least number of flights row by row.
    """
    order = [F.desc("severe"), F.desc("num")]
    if ties == "arrival":
        order.append(F.asc_nulls_last("first_seq"))
    per_window = Window.partitionBy(*window).orderBy(*order, F.asc("origin"))
    least = F.lit(settings.min_flights) if min_flights is None else min_flights
    return (
        stats.where(F.col("num") >= least)
        .withColumn("rank", F.row_number().over(per_window))
        .where(F.col("rank") <= settings.top_k)
    )


def ranking_report(ranked: DataFrame, *more: Column) -> DataFrame:
    return ranked.select(
        stamp(F.col("ws")).alias("ts"),
        "rank",
        F.col("origin").alias("origin_airport_id"),
        F.col("num").alias("num_flights"),
        F.col("severe").alias("severe_delays"),
        ratio(F.col("sum_delay"), F.col("num")).alias("dep_delay_mean"),
        F.col("max_delay").alias("dep_delay_max"),
        *more,
    )


def preagg_report(stats: DataFrame, *more: Column) -> DataFrame:
    """The pre-aggregate in its file layout, unrounded."""
    return stats.select(
        stamp(F.col("ws")).alias("window_start"),
        stamp(F.col("we")).alias("window_end"),
        F.col("origin").alias("airport_id"),
        "num", "severe", "sum_delay", "max_delay",
        *more,
    )


def preagg_stats(preagg: DataFrame) -> DataFrame:
    """Pre-aggregates read back from files, as statistics that can be ranked."""
    return preagg.select(
        stamp_to_ms(F.col("window_start")).alias("ws"),
        stamp_to_ms(F.col("window_end")).alias("we"),
        F.col("airport_id").alias("origin"),
        "num", "severe", "sum_delay", "max_delay",
    )


def roll_up(stats: DataFrame) -> DataFrame:
    """Window statistics added up per airport, over the span all windows cover together."""
    per_airport = stats.groupBy("origin").agg(
        F.sum("num").alias("num"),
        F.sum("severe").alias("severe"),
        F.sum("sum_delay").alias("sum_delay"),
        F.max("max_delay").alias("max_delay"),
        F.min("ws").alias("first_ws"),
        F.max("we").alias("last_we"),
    ).withColumn("whole", F.lit(0))
    whole = Window.partitionBy("whole")
    return per_airport.select(
        F.min("first_ws").over(whole).alias("ws"),
        F.max("last_we").over(whole).alias("we"),
        "origin", "num", "severe", "sum_delay", "max_delay",
    )


def window_summary(stats: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Per window: airports seen, airports that qualify, flights and severe delays."""
    return stats.groupBy("ws", "we").agg(
        F.count("*").alias("airports"),
        F.count_if(F.col("num") >= settings.min_flights).alias("qualifying"),
        F.sum("num").alias("flights"),
        F.sum("severe").alias("severe_delays"),
    )


def run_counts(stats: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row of diagnostics: (window, airport) rows, qualifying ones, and their windows."""
    qualifies = F.col("num") >= settings.min_flights
    return stats.agg(
        F.count("*").alias("rows"),
        F.count_if(qualifies).alias("qualifying_rows"),
        F.count_distinct(F.when(qualifies, F.col("ws"))).alias("qualifying_windows"),
    )
