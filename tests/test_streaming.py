import pytest
from pyspark.sql import functions as F

from tarmac.operators.airports import airport_stats, preagg_report, with_window
from tarmac.operators.carriers import hourly_carrier_stats
from tarmac.operators.flights import flown
from tarmac.operators.worst import worst_flights
from tarmac.plans.airports import severe_flights
from tarmac.session import scratch
from tarmac.settings import DAY_MS, HOUR_MS, Settings
from tarmac.sources.lines import end_line, parse_carrier_flights, read_lines, stream_lines, to_lines
from tarmac.sources.tables import table_monthly
from tarmac.streaming.lists import merge_candidates, worst_flights_stream
from tarmac.streaming.replay import feed, write_replay
from tarmac.streaming.reports import airport_stream, carrier_stream
from tarmac.streaming.sinks import ClosedStreamError, all_of, each_batch, finish, refuse_after_end, to_csv


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_replay_files_hold_the_events_in_order(spark, flights):
    path = scratch(spark, "replay")
    write_replay(table_monthly(flights), path, 4, close=False)
    lines = read_lines(spark, path).select(
        "_metadata.file_modification_time", F.split("value", ",")[17].cast("long").alias("seq")
    )
    files = lines.groupBy("file_modification_time").agg(
        F.min("seq").alias("low"), F.max("seq").alias("high"), F.count("*").alias("n")
    ).orderBy("file_modification_time").collect()
    assert len(files) == 4 and sum(f.n for f in files) == flights.count()
    assert all(a.high < b.low for a, b in zip(files, files[1:]))


def test_streams_equal_batches(spark, flights):
    root = scratch(spark, "streams")
    lines = f"{root}/lines"
    write_replay(table_monthly(flights), lines, 3, close=True)
    sizes = {"1h": HOUR_MS, "6h": 6 * HOUR_MS, "120d": 120 * DAY_MS}
    streams = {
        name: preagg_report(airport_stream(stream_lines(spark, lines, 1), step))
        for name, step in sizes.items()
    }
    all_of(
        {
            name: lambda n=name, s=stream: to_csv(s, f"{root}/{n}", f"{root}/state-{n}")
            for name, stream in streams.items()
        }
    )
    for name, step in sizes.items():
        got = spark.read.schema(streams[name].schema).csv(f"{root}/{name}")
        assert same(got, preagg_report(airport_stats(flown(flights), step)))

    carriers = carrier_stream(stream_lines(spark, lines))
    to_csv(carriers, f"{root}/q1", f"{root}/state-q1", by_hour=True).awaitTermination()
    got = spark.read.schema(carriers.schema).option("basePath", f"{root}/q1").csv(f"{root}/q1")
    assert "proc_hour" in got.columns
    batch = hourly_carrier_stats(flights)
    assert same(got.select(*batch.columns), batch)
    assert same(hourly_carrier_stats(parse_carrier_flights(read_lines(spark, lines))), batch)


def test_streamed_lists_equal_batch_lists(spark, flights):
    """A list of three over a 120-day window: every state trims, in every micro-batch."""
    settings, step = Settings(list_length=3), 120 * DAY_MS
    root = scratch(spark, "lists")
    write_replay(table_monthly(flights), f"{root}/lines", 3, close=True)
    stream = worst_flights_stream(stream_lines(spark, f"{root}/lines", 1), step, settings)
    each_batch(
        stream, f"{root}/out", f"{root}/state", lambda batch: merge_candidates(batch, settings)
    ).awaitTermination()
    want = worst_flights(with_window(severe_flights(flights, settings), step), settings)
    got = spark.read.parquet(f"{root}/out").drop("batch")
    assert got.count() > 20 and same(got, want)


def test_a_closed_stream_refuses_more_lines(spark, flights):
    root = scratch(spark, "closed")
    events = table_monthly(flights)
    write_replay(events.where("seq < 300"), f"{root}/lines", 2, close=True)
    report = carrier_stream(stream_lines(spark, f"{root}/lines"))

    def run():
        finish(to_csv(report, f"{root}/out", f"{root}/state"))

    refuse_after_end(spark, f"{root}/lines", f"{root}/state")  # no checkpoint yet
    run()
    refuse_after_end(spark, f"{root}/lines", f"{root}/state")
    run()  # nothing new
    to_lines(events.where("seq >= 300")).write.mode("append").text(f"{root}/lines")
    with pytest.raises(ClosedStreamError, match="not read"):  # before any line is taken
        refuse_after_end(spark, f"{root}/lines", f"{root}/state")
    with pytest.raises(ClosedStreamError):
        run()


def test_late_rows(spark):
    """Late rows of an emitted hour are dropped; those of an open hour still count."""
    root = scratch(spark, "late")

    def at(*minutes):
        rows = [f"2025,1,1,AA,1,2,0,10.0,,0,0,,,,,,{minute * 60_000}" for minute in minutes]
        return spark.createDataFrame([(row,) for row in rows], "value string")

    at().write.text(f"{root}/lines")
    report = carrier_stream(stream_lines(spark, f"{root}/lines"))
    feed(
        [at(5, 10, 70), at(30, 65, 61), at(200), end_line(spark)],
        f"{root}/lines",
        lambda: to_csv(report, f"{root}/out", f"{root}/state"),
    )
    got = spark.read.schema(report.schema).csv(f"{root}/out").orderBy("window_start").collect()
    assert [(r.window_start[11:13], r.num_flights) for r in got] == [("00", 2), ("01", 3), ("03", 1)]


def test_lines_without_a_place_in_the_stream(spark, flights):
    root = scratch(spark, "plain")
    lines = to_lines(table_monthly(flights), seq=None).unionByName(end_line(spark))
    lines.write.text(f"{root}/lines")
    stream = worst_flights_stream(stream_lines(spark, f"{root}/lines"), 120 * DAY_MS)
    each_batch(stream, f"{root}/out", f"{root}/state", merge_candidates).awaitTermination()
    want = worst_flights(with_window(severe_flights(flights), 120 * DAY_MS))
    columns = ["origin", "place", "dep_delay", "event_time"]
    assert same(spark.read.parquet(f"{root}/out").select(*columns), want.select(*columns))


@pytest.mark.parametrize("shares", [1, 16])
def test_late_flights_do_not_split_a_list(spark, shares):
    """A flight for an hour that closes in its own micro-batch is late, list and all shares."""
    root = scratch(spark, "late-lists")
    for minutes in ([(5, 40), (10, 50), (15, 45), (130, 31)], [(20, 99), (25, 98), (131, 32)]):
        rows = [f"2025,1,1,AA,1,2,0,{d}.0,,0,0,,,,,,{m * 60_000}" for m, d in minutes]
        frame = spark.createDataFrame([(row,) for row in rows], "value string").coalesce(1)
        frame.write.mode("append").text(f"{root}/lines")
    end_line(spark).write.mode("append").text(f"{root}/lines")
    lines = stream_lines(spark, f"{root}/lines", 1)
    stream = worst_flights_stream(lines, HOUR_MS, shares=shares)
    each_batch(stream, f"{root}/out", f"{root}/state", merge_candidates).awaitTermination()
    got = spark.read.parquet(f"{root}/out").orderBy("ws", "place").collect()
    assert [(r.ws // HOUR_MS, r.place, r.dep_delay) for r in got] == [
        (0, 1, 50.0), (0, 2, 45.0), (0, 3, 40.0), (2, 1, 32.0), (2, 2, 31.0)
    ]
