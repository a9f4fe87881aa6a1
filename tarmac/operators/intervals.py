"""Join of timed rows to the time windows that cover them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.session import fits_broadcast, settle

#: Events of a (key, slot) that one task is to take.
EVENTS_PER_COPY = 1 << 20


def interval_join(
    events: DataFrame, windows: DataFrame, key: str, time: str = "event_time",
    start: str = "ws", end: str = "we",
) -> DataFrame:
    """Every (event, window) pair with equal `key` and start <= time < end.

    `windows` must be settled. A plain join on the key would test each event against all windows
    of its airport. Instead time is cut into slots at least as long as the window, one slot size
    (a power of two) per window length class: a window then touches at most two slots, an event
    lies in exactly one, and the join is an equality on (key, class, slot) with the bounds as a
    rest condition. Both sides agree on one slot per pair, so no pair comes out twice.

    Few windows are broadcast. Otherwise both sides shuffle, and a (key, slot) that the events' counts
    show to be busy has a copy of its windows for every EVENTS_PER_COPY of them, over which they are
    dealt out; any other has one.
    """
    length = F.col(end) - F.col(start)
    classed = windows.where(length > 0).withColumn(
        "span", F.ceil(F.log2(length.cast("double"))).cast("int")
    )
    spans = sorted(row.span for row in classed.select("span").distinct().collect())
    slotted = classed.withColumn(
        "slot",
        F.explode(F.expr(f"sequence(shiftright({start}, span), shiftright({end} - 1, span))")),
    )
    timed = events.withColumn(
        "span", F.explode(F.array(*[F.lit(s) for s in spans]).cast("array<int>"))
    ).withColumn("slot", F.expr(f"shiftright({time}, span)"))
    on = [key, "span", "slot"]
    if fits_broadcast(windows):
        right = F.broadcast(slotted)
    else:
        busy = settle(busy_slots(timed, on))
        busy = F.broadcast(busy) if fits_broadcast(busy) else busy
        copies = F.coalesce("copies", F.lit(1))
        right = slotted.join(busy, on, "left").withColumn(
            "salt", F.explode(F.sequence(F.lit(0), copies - 1))
        ).drop("copies")
        timed = timed.join(busy, on, "left").withColumn(
            "salt", F.pmod(F.xxhash64(*events.columns), copies).cast("int")
        ).drop("copies")
        on = [*on, "salt"]
    joined = timed.join(right, on)
    covered = (F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))
    return joined.where(covered).drop("span", "slot", "salt")


def busy_slots(timed: DataFrame, on: list[str]) -> DataFrame:
    """The groups of `timed` by `on` that need more than one copy of their windows, and how many."""
    copies = F.ceil(F.count("*") / EVENTS_PER_COPY).cast("int")
    return timed.groupBy(*on).agg(copies.alias("copies")).where("copies > 1")
