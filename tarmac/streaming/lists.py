"""The worst flights of each (window, airport) on a stream, in bounded state.

Spark has no built-in aggregate that keeps the N largest rows, and collecting a window's flights
would put a busy airport's whole window into one state row. So the state here is a short list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tarmac.functions.numbers import two_decimals_sql
from tarmac.functions.times import bucket_start
from tarmac.operators.airports import in_spans
from tarmac.operators.flights import is_severe
from tarmac.operators.worst import worst_flights
from tarmac.settings import DEFAULTS, Settings
from tarmac.sources.lines import END_CARRIER, parse_airport_flights
from tarmac.streaming.reports import in_event_time, tumbling
from tarmac.streaming.spans import STATS, merged

_FLIGHT = ["dep_delay", "seq", "event_time", "carrier", "dest"]
_COLUMNS = ["ws", "we", "origin", *_FLIGHT]
_ORDER, _ASCENDING = ["dep_delay", "seq", "event_time"], [False, True, True]
_OUTPUT = (
    "ws bigint, we bigint, origin int, dep_delay double, seq bigint, event_time bigint, "
    "carrier string, dest int"
)
_STATE = (
    "dep_delay array<double>, seq array<bigint>, event_time array<bigint>, "
    "carrier array<string>, dest array<int>"
)


def worst_flights_stream(
    lines: DataFrame, step_ms: int, settings: Settings = DEFAULTS, shares: int = 16
) -> DataFrame:
    """Candidates for the list of each (window, airport), emitted when the window closes.

    Scan tasks cut each Arrow batch to the lists it can fill. What is left of an airport is dealt
    out over `shares` states of `list_length` flights each, which `merge_candidates` joins. The
    end line passes the severity filter so that it can move event time.
    """
    length = settings.list_length
    flights = parse_airport_flights(lines, keep_end=True).where(
        is_severe(settings) | (F.col("carrier") == END_CARRIER)
    )
    in_window = flights.select(
        "origin", bucket_start(F.col("event_time"), step_ms).alias("ws"), *_FLIGHT
    ).withColumn("seq", F.coalesce("seq", "event_time"))  # lines may lack the place

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.sort_values(_ORDER, ascending=_ASCENDING).groupby(["origin", "ws"]).head(
                length
            )

    share = F.pmod(F.xxhash64("event_time", "seq", "carrier", "dest"), F.lit(shares))
    dealt = in_event_time(in_window.mapInPandas(cut, in_window.schema), settings).select(
        tumbling(step_ms).alias("window"),
        F.lit(step_ms).cast("bigint").alias("step"),
        "origin", "ws", share.cast("int").alias("share"), *_FLIGHT,
    )

    def keep(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        origin, ws, _, step = (int(part) for part in key)
        best = pd.DataFrame(dict(zip(_FLIGHT, state.get))) if state.exists else None
        if state.hasTimedOut or ws + step <= state.getCurrentWatermarkMs():
            # The window closes in this micro-batch, for all shares alike: flights that come for
            # it only now are late.
            if best is not None:
                state.remove()
                yield best.assign(ws=ws, we=ws + step, origin=origin)[_COLUMNS]
            return
        for batch in batches:
            seen = batch[_FLIGHT] if best is None else pd.concat([best, batch[_FLIGHT]])
            best = seen.sort_values(_ORDER, ascending=_ASCENDING).head(length)
        state.update(tuple(best[name].tolist() for name in _FLIGHT))
        state.setTimeoutTimestamp(ws + step - 1)

    return dealt.groupBy("origin", "ws", "share", "step").applyInPandasWithState(
        keep, _OUTPUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def merge_candidates(batch: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The final lists of the windows that closed in this micro-batch."""
    return worst_flights(batch, settings)


# Statistics and list in one state.

_LISTED = "dep_delay double, seq bigint, event_time bigint, carrier string, dest int"
_PART = f"origin int, ws bigint, event_time bigint, {STATS}, worst array<struct<{_LISTED}>>"
_CLOSED = f"span string, ws bigint, we bigint, origin int, {STATS}, worst array<struct<{_LISTED}>>"
_Closed = Row("span", "ws", "we", "origin", "num", "severe", "sum_delay", "max_delay", "first_seq", "worst")
_Flight = Row(*_FLIGHT)


def _place(flight) -> tuple:
    """Sorts flights as their list does: longest delay first, then arrival."""
    return -flight[0], flight[1] is None, flight[1] or 0, flight[2]


def _parts(flights: DataFrame, settings: Settings) -> DataFrame:
    """For each Arrow batch, window and airport: the sums, and the flights that can still be listed."""
    length, severe = settings.list_length, settings.severe_minutes

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            delay = batch["dep_delay"]
            batch = batch.assign(severe=delay > severe, odd=delay.isna())
            keys = ["origin", "ws"]
            sums = batch.groupby(keys, sort=False).agg(
                event_time=("event_time", "max"), num=("severe", "size"), severe=("severe", "sum"),
                sum_delay=("dep_delay", "sum"), max_delay=("dep_delay", "max"), first_seq=("seq", "min"), odd=("odd", "any"),
            )
            sums["sum_delay"] = sums["sum_delay"].where(~sums["odd"], np.nan)
            best = batch[batch["severe"]].sort_values(_ORDER, ascending=_ASCENDING).groupby(keys).head(length)
            lists: dict[tuple, list] = {}
            for origin, ws, *flight in best[[*keys, *_FLIGHT]].itertuples(index=False, name=None):
                lists.setdefault((origin, ws), []).append(dict(zip(_FLIGHT, flight)))
            sums["worst"] = [lists.get(key, []) for key in sums.index]
            yield sums.drop(columns="odd").reset_index()

    return flights.mapInPandas(part, _PART)


class OpenWindow(StatefulProcessor):
    """One (span, window, airport): a row of sums, its worst flights so far, and a timer at its end."""

    def __init__(self, steps: dict[str, int], length: int):
        self.steps, self.length = steps, length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", STATS)
        self.worst = handle.getListState("worst", _LISTED)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        span, ws, _ = key
        sums, new = None, []
        for row in rows:
            own = (row.num, row.severe, row.sum_delay, row.max_delay, row.first_seq)
            sums = merged(sums, own) if sums else own
            listed = [tuple(flight[name] for name in _FLIGHT) for flight in row.worst]
            new = sorted([*new, *listed], key=_place)[: self.length]
        if self.sums.exists():
            sums = merged(self.sums.get(), sums)
        else:
            self.handle.registerTimer(ws + self.steps[span] - 1)
        self.sums.update(sums)
        if new:
            self.worst.put(sorted([*map(tuple, self.worst.get()), *new], key=_place)[: self.length])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        span, ws, origin = key
        worst = [_Flight(*flight) for flight in self.worst.get()]
        yield _Closed(span, ws, ws + self.steps[span], origin, *self.sums.get(), worst)
        self.sums.clear()
        self.worst.clear()


def airport_lists_stream(
    lines: DataFrame, spans: dict[str, int], settings: Settings = DEFAULTS
) -> DataFrame:
    """Statistics and `delayed` list of each airport, for several window lengths in one query.

    Scan tasks cut each Arrow batch to sums and short lists, which one state for each (span, window,
    airport) adds up and hands over when the window closes. A flight that is late for the shortest
    window is late for all. Start it with `spans.start_with_rocksdb`.
    """
    base = min(spans.values())
    if any(step % base for step in spans.values()):
        raise ValueError("longer windows must be multiples of the shortest")
    flights = parse_airport_flights(lines, keep_end=True).select(
        "origin", bucket_start(F.col("event_time"), base).alias("ws"), *_FLIGHT
    ).withColumn("seq", F.coalesce("seq", "event_time"))
    parts = in_event_time(_parts(flights, settings), settings)
    dealt = parts.select(
        tumbling(base).alias("window"), "origin", *[c.split()[0] for c in STATS.split(", ")], "worst",
        F.explode(in_spans(F.col("ws"), spans)).alias("s"),
    ).select("*", "s.span", F.col("s.slot").alias("ws")).drop("s")
    closed = dealt.groupBy("span", "ws", "origin").transformWithState(
        OpenWindow(spans, settings.list_length), _CLOSED, "Append", "EventTime"
    )
    minutes = two_decimals_sql("f.dep_delay")
    listed = F.expr(
        f"transform(worst, f -> named_struct('carrier', f.carrier, 'dest', f.dest, 'minutes', {minutes}))"
    )
    return closed.withColumn("delayed", listed).drop("worst")
