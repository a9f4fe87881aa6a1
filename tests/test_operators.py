import random
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import tarmac.operators.intervals as intervals
import tarmac.operators.worst as worst_module
from tarmac.operators.airports import (
    airport_stats,
    preagg_report,
    preagg_stats,
    rank_airports,
    roll_up,
    with_window,
)
from tarmac.operators.carriers import hourly_carrier_stats
from tarmac.operators.flights import flown
from tarmac.operators.intervals import interval_join
from tarmac.operators.ordering import with_position
from tarmac.operators.worst import worst_flights
from tarmac.plans.airports import airport_report, delayed_flights, severe_flights
from tarmac.plans.postprocess import report_from_preagg
from tarmac.session import fits_broadcast, settle
from tarmac.settings import DEFAULTS, HOUR_MS, Settings

FLIGHT = (
    "seq bigint, event_time bigint, carrier string, origin int, dest int, dep_delay double, "
    "cancelled double, diverted double"
)


def random_flights(spark, n, hot_share=0.34, seed=5, hours=6):
    """A third of all flights leave one airport in one hour, many with equal delays."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        hot = rng.random() < hot_share
        rows.append(
            (
                seq,
                HOUR_MS * 7 + rng.randrange(HOUR_MS) if hot else rng.randrange(hours * HOUR_MS),
                rng.choice(["AA", "DL", "UA", "WN", "B6"]),
                1 if hot else rng.randrange(1, 9),
                rng.randrange(100, 120),
                rng.choice([None, -5.0, 10.0, 15.0, 16.0, 30.0, 31.0, float(rng.randrange(31, 60))]),
                float(rng.random() < 0.1),
                float(rng.random() < 0.05),
            )
        )
    return rows, spark.createDataFrame(rows, FLIGHT).repartition(7)


def brute_worst(rows, step, order):
    groups = defaultdict(list)
    for seq, at, carrier, origin, dest, delay, cancelled, diverted in rows:
        if cancelled < 1 and diverted < 1 and delay is not None and delay > 30:
            ws = at // step * step
            groups[ws, origin].append((seq, carrier, dest, delay))
    return {k: sorted(v, key=order)[:20] for k, v in groups.items()}


def test_carrier_stats_by_hand(spark):
    rows = [
        (0, 0, "AA", 1, 2, 16.0, 0.0, 0.0),
        (1, 1, "AA", 1, 2, 15.0, 0.0, 0.0),  # exactly 15 is not late
        (2, 2, "AA", 1, 2, 20.0, 0.0, 1.0),  # diverted flights count as late
        (3, 3, "AA", 1, 2, 99.0, 1.0, 0.0),  # cancelled ones do not
        (4, 4, "AA", 1, 2, None, 0.0, 0.0),  # a blank delay is zero
        (5, 5, "AA", 1, 2, 0.0, 1.0, 1.0),
        (6, HOUR_MS, "AA", 1, 2, 1.0, 1.0, 0.0),  # on the hour: next window; all cancelled
        (7, 7, "OO", 1, 2, 1.0, 0.0, 0.0),
    ]
    got = hourly_carrier_stats(spark.createDataFrame(rows, FLIGHT)).orderBy("window_start").collect()
    assert tuple(got[0]) == (
        "1970-01-01 00:00:00", "1970-01-01 01:00:00", "AA", 6, 3, 2, 2,
        51.0 / 4, 2 / 6 * 100.0, 50.0,
    )
    assert tuple(got[1])[3:] == (1, 0, 1, 0, 0.0, 100.0, 0.0)
    assert len(got) == 2


def test_blank_flags(spark):
    rows = [(0, 0, "AA", 1, 2, 1.0, None, 0.0), (1, 0, "AA", 1, 2, None, 0.0, 0.0),
            (2, 0, "AA", 1, 2, 1.0, 1.0, 0.0)]
    flights = spark.createDataFrame(rows, FLIGHT)
    assert sorted(r.dep_delay for r in flown(flights).collect()) == [0.0, 1.0]
    assert [r.dep_delay for r in flown(flights, blank_flags="drop").collect()] == [0.0]


def test_worst_flights_match_brute_force_with_a_hot_airport(spark):
    rows, flights = random_flights(spark, 4000)
    severe = with_window(severe_flights(flights), HOUR_MS)
    orders = {
        "arrival": lambda f: (-f[3], f[0]),
        "key_desc": lambda f: (-f[3], [-ord(c) for c in f[1]], -f[2]),
    }
    for ties, order in orders.items():
        want = brute_worst(rows, HOUR_MS, order)
        got = defaultdict(list)
        for r in worst_flights(severe, ties=ties).orderBy("place").collect():
            got[r.ws, r.origin].append((r.carrier, r.dest, r.dep_delay))
        assert dict(got) == {k: [f[1:] for f in v] for k, v in want.items()}


def test_worst_flights_cut_before_both_shuffles(spark):
    _, flights = random_flights(spark, 500)
    lists = worst_flights(with_window(severe_flights(flights), HOUR_MS))
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Partial") >= 2 and plan.count("WindowGroupLimit") == 4


@pytest.mark.parametrize("step", [HOUR_MS, 6 * HOUR_MS, None])
def test_report_is_the_same_without_the_broadcast(spark, flights, step, monkeypatch):
    settings = Settings(min_flights=2)
    want = airport_report(flights, step, settings).collect()
    monkeypatch.setattr(worst_module, "fits_broadcast", lambda *_: False)
    assert sorted(airport_report(flights, step, settings).collect()) == sorted(want)


@pytest.mark.parametrize("small", [True, False])
def test_interval_join_matches_brute_force(spark, small, monkeypatch):
    monkeypatch.setattr(intervals, "fits_broadcast", lambda *_: small)
    monkeypatch.setattr(intervals, "EVENTS_PER_COPY", 7)
    rng = random.Random(3)
    windows = [(rng.randrange(-50, 900), rng.randrange(1, 4)) for _ in range(60)]
    # All lengths from 1 to the whole range, exact powers of two among them, and an empty one.
    windows = [(s, s + rng.choice([1, 2, 7, 64, 100, 1024]), o) for s, o in windows]
    windows += [(10, 10, 1), (-100, 2000, 1)]
    events = [(n, rng.randrange(-60, 1100), rng.randrange(1, 5)) for n in range(800)]
    settled = settle(spark.createDataFrame(windows, "ws bigint, we bigint, origin int"))
    frame = spark.createDataFrame(events, "seq bigint, event_time bigint, origin int")
    joined = interval_join(frame, settled, "origin")
    got = sorted((r.seq, r.ws, r.we) for r in joined.collect())
    want = sorted(
        (n, s, e) for n, t, o in events for s, e, p in windows if o == p and s <= t < e
    )
    assert got == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_only_busy_keys_get_copies(spark, monkeypatch):
    """A key with a third of the events has a copy for every EVENTS_PER_COPY, all others have one."""
    monkeypatch.setattr(intervals, "EVENTS_PER_COPY", 50)
    rows = [(1 if n % 3 == 0 else 2 + n % 40, 10, n % 7) for n in range(900)]
    frame = spark.createDataFrame(rows, "origin int, span int, slot int")
    busy = intervals.busy_slots(frame, ["origin", "span"]).collect()
    hot = sum(o == 1 for o, *_ in rows)
    assert [tuple(b) for b in busy] == [(1, 10, -(-hot // 50))]


def test_positions_of_one_hot_minute(spark):
    """Equal times spread over pieces; the numbers are still gap-free and in source order."""
    rng = random.Random(1)
    rows = [(60_000 if rng.random() < 0.5 else rng.randrange(5) * 60_000, n) for n in range(5000)]
    rows += [(3 * 24 * HOUR_MS, n) for n in range(5000, 5050)]
    no_time = [(None, n) for n in range(5050, 5060)]
    frame = spark.createDataFrame(rows + no_time, "event_time bigint, id bigint").repartition(5)
    got = with_position(frame, ["event_time", "id"], "place").collect()
    want = {n: place for place, (_, n) in enumerate(sorted(rows) + no_time)}
    assert {r.id: r.place for r in got} == want
    assert with_position(frame.where("false"), ["event_time", "id"]).isEmpty()


def test_roll_up_equals_the_direct_aggregate(flights):
    columns = ["origin", "num", "severe", "sum_delay", "max_delay"]
    rolled = roll_up(airport_stats(flown(flights), HOUR_MS))
    whole = airport_stats(flown(flights), None)
    assert sorted(rolled.select(*columns).collect()) == sorted(whole.select(*columns).collect())
    hours, all_ = rolled.first(), whole.first()
    assert hours.ws <= all_.ws < all_.we <= hours.we
    assert all_.ws // HOUR_MS * HOUR_MS == hours.ws


def test_hours_add_up_to_six_hours(flights):
    step = 6 * HOUR_MS
    hours = airport_stats(flown(flights), HOUR_MS)
    summed = hours.withColumn("ws", F.col("ws") - F.pmod("ws", F.lit(step))).groupBy(
        "ws", "origin"
    ).agg(F.sum("num").alias("num"), F.sum("severe").alias("severe"),
          F.max("max_delay").alias("max_delay"))
    direct = airport_stats(flown(flights), step).select(*summed.columns)
    assert sorted(summed.collect()) == sorted(direct.collect())
    assert direct.agg(F.sum("num")).first()[0] == flown(flights).count()


def test_report_invariants(flights):
    settings = replace(DEFAULTS, min_flights=2, top_k=3)
    report = airport_report(flights, 6 * HOUR_MS, settings)
    by_ts = defaultdict(list)
    for r in report.orderBy("ts", "rank").collect():
        by_ts[r.ts].append(r)
    for rows in by_ts.values():
        assert [r.rank for r in rows] == list(range(1, len(rows) + 1)) and len(rows) <= 3
        severe = [r.severe_delays for r in rows]
        assert severe == sorted(severe, reverse=True)
        for r in rows:
            delays = [float(i.split(",")[2]) for i in r.delayed_flights[2:-2].split("), (") if i]
            assert len(delays) == min(r.severe_delays, 20)
            assert delays == sorted(delays, reverse=True)
            assert not delays or delays[0] == r.dep_delay_max
            assert delays or r.delayed_flights == "[]"
    listed = delayed_flights(flights, 6 * HOUR_MS, settings)
    assert listed.count() == report.agg(
        F.sum(F.least("severe_delays", F.lit(20)))
    ).first()[0]


def test_rank_ties(spark):
    stats = spark.createDataFrame(
        [(0, 1, 5, 40, 3, 0.0, 0.0, 9), (0, 1, 6, 40, 3, 0.0, 0.0, 2), (0, 1, 7, 41, 3, 0.0, 0.0, 5),
         (0, 1, 8, 29, 9, 0.0, 0.0, 1)],
        "ws bigint, we bigint, origin int, num bigint, severe bigint, sum_delay double, "
        "max_delay double, first_seq bigint",
    )
    order = lambda ties: [
        r.origin for r in rank_airports(stats, ties=ties).orderBy("rank").collect()
    ]
    assert order("arrival") == [7, 6, 5]
    assert order("airport") == [7, 5, 6]


def test_report_from_preaggregates_agrees_with_the_direct_one(flights):
    settings = Settings(min_flights=2)
    stored = preagg_report(airport_stats(flown(flights), 6 * HOUR_MS))
    columns = ["ts", "num_flights", "severe_delays", "dep_delay_mean", "dep_delay_max"]
    post = report_from_preagg(stored, flights, settings=settings, ties="arrival")
    direct = airport_report(flights, 6 * HOUR_MS, settings)
    # Equal airports may swap places between the two, so their rank and id are left out.
    few = F.col("rank") <= 10
    assert sorted(post.where(few).select(*columns).collect()) == sorted(
        direct.where(few).select(*columns).collect()
    )
    assert preagg_stats(stored).count() == stored.count()


def test_broadcast_bound(spark):
    settled = settle(spark.range(11))
    assert fits_broadcast(settled, 11 * 16) and not fits_broadcast(settled, 11 * 16 - 1)
    text = settle(spark.range(3).select(F.lit("x" * 100).alias("t")))
    assert fits_broadcast(text, 3 * 116) and not fits_broadcast(text, 3 * 116 - 1)
    assert fits_broadcast(settled.where("false"), 0)
