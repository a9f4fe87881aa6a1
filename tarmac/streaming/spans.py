"""Several window lengths from one pass over a stream.

The shortest window is a plain windowed aggregation of the lines. Its closed rows go on, in the same
query, to a second stateful step that adds them up to the longer windows, each with a timer at its
end. So the lines are read and parsed once, and all that crosses into Python is a row per closed
(shortest window, airport).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tarmac.operators.airports import airport_measures
from tarmac.settings import DEFAULTS, Settings
from tarmac.sources.lines import parse_airport_flights
from tarmac.streaming.reports import in_event_time, tumbling

STATS = "num bigint, severe bigint, sum_delay double, max_delay double, first_seq bigint"
OUTPUT = f"span string, ws bigint, we bigint, origin int, {STATS}"
_Closed = Row(*[column.split()[0] for column in OUTPUT.split(", ")])
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_with_rocksdb(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a query whose state needs timers; the session's own choice of state store stays.

    A query keeps the settings it was started with.
    """
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return start()
    finally:
        spark.conf.set(_PROVIDER, before)


def merged(a, b):
    """Two rows of sums (num, severe, sum_delay, max_delay, first_seq) as one."""
    def pick(choose, x, y):
        return y if x is None else x if y is None else choose(x, y)

    return (a[0] + b[0], a[1] + b[1], a[2] + b[2], pick(max, a[3], b[3]), pick(min, a[4], b[4]))


class LongerWindows(StatefulProcessor):
    """Adds closed windows of one airport up to longer ones and hands both on.

    State is one row of sums for each open longer window.
    """

    def __init__(self, base: str, longer: dict[str, int]):
        self.base, self.longer = base, longer

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getMapState("sums", "span string, ws bigint", STATS)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        come = {}
        for row in rows:
            sums = (row.num, row.severe, row.sum_delay, row.max_delay, row.first_seq)
            yield _Closed(self.base, row.ws, row.we, key[0], *sums)
            for span, step in self.longer.items():
                place = (span, row.ws - row.ws % step)
                come[place] = merged(come[place], sums) if place in come else sums
        for place, sums in come.items():
            if self.sums.containsKey(place):
                sums = merged(self.sums.getValue(place), sums)
            else:
                self.handle.registerTimer(place[1] + self.longer[place[0]] - 1)
            self.sums.updateValue(place, sums)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = expiredTimerInfo.getExpiryTimeInMs() + 1
        for span, step in self.longer.items():
            place = (span, end - step)
            if self.sums.containsKey(place):
                yield _Closed(span, end - step, end, key[0], *self.sums.getValue(place))
                self.sums.removeKey(place)


def airport_spans_stream(
    lines: DataFrame, spans: dict[str, int], settings: Settings = DEFAULTS
) -> DataFrame:
    """airport_stream of several window lengths at once, told apart by `span`.

    The longer lengths must be multiples of the shortest. A flight that is late for its shortest
    window is late for all.
    """
    base = min(spans, key=spans.get)
    if any(step % spans[base] for step in spans.values()):
        raise ValueError("longer windows must be multiples of the shortest")
    longer = {span: step for span, step in spans.items() if span != base}
    flights = in_event_time(parse_airport_flights(lines, keep_end=True), settings)
    closed = flights.groupBy(tumbling(spans[base]), "origin").agg(*airport_measures(settings)).select(
        F.window_time("window").alias("closed"), F.unix_millis("window.start").alias("ws"),
        F.unix_millis("window.end").alias("we"), "origin", "num", "severe", "sum_delay", "max_delay", "first_seq",
    )
    return closed.groupBy("origin").transformWithState(
        LongerWindows(base, longer), OUTPUT, "Append", "EventTime"
    )
