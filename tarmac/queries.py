"""Every report and operator as a query over the test tables: name -> (spark, folder) -> frame.

The small test tables have few flights per airport and window, so the minimum number of flights
is 2 per hour and 3 per six hours there; everything else keeps its default.
"""

from __future__ import annotations

import functools
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.functions.lists import bracketed, piped
from tarmac.functions.times import stamp
from tarmac.operators.airports import (
    airport_stats,
    preagg_report,
    rank_airports,
    ranking_report,
    run_counts,
    window_summary,
)
from tarmac.operators.carriers import carrier_text, hourly_carrier_stats
from tarmac.operators.flights import flown
from tarmac.operators.ordering import with_position
from tarmac.plans.airports import (
    airport_lists,
    airport_preagg,
    airport_preagg_lists,
    airport_ranking,
    airport_report,
    airport_reports,
    delayed_flights,
)
from tarmac.plans.postprocess import (
    flights_in_windows,
    ranking_from_preagg,
    report_from_preagg,
    reports_from_preagg,
)
from tarmac.plans.prepare import prepare_events, with_event_time
from tarmac.schema import EVENTS, MONTHLY
from tarmac.session import scratch, settle
from tarmac.settings import DEFAULTS, WINDOWS_MS, Settings
from tarmac.sinks.files import (
    ranking_text,
    write_by_hour,
    write_event_table,
    write_events,
    write_preagg,
    write_ranking,
    write_rankings,
)
from tarmac.sources.files import (
    read_flights,
    read_flights_tolerant,
    read_monthly,
    read_preagg,
)
from tarmac.sources.lines import (
    end_line,
    parse_airport_flights,
    parse_carrier_flights,
    parse_events,
    read_lines,
    stream_lines,
    to_lines,
)
from tarmac.sources.tables import damaged_lines, table_flights, table_monthly
from tarmac.streaming.lists import airport_lists_stream, merge_candidates, worst_flights_stream
from tarmac.streaming.replay import feed, write_replay
from tarmac.streaming.reports import airport_stream, carrier_stream
from tarmac.streaming.sinks import each_batch, finish, to_csv, to_folders
from tarmac.streaming.spans import airport_spans_stream, start_with_rocksdb

STEPS = {"1h": WINDOWS_MS["1h"], "6h": WINDOWS_MS["6h"], "global": None}
MIN_FLIGHTS = {"1h": 2, "6h": 3, "global": 30}
MICRO_BATCHES = 3


def settings_for(size: str) -> Settings:
    return replace(DEFAULTS, min_flights=MIN_FLIGHTS[size])


# Carriers by hour


def q1_hourly_carrier_stats(spark: SparkSession, folder: str) -> DataFrame:
    return hourly_carrier_stats(table_flights(spark, folder))


def q1_report_text(spark: SparkSession, folder: str) -> DataFrame:
    return carrier_text(hourly_carrier_stats(table_flights(spark, folder)))


# Airports: ranking, flights behind it, full report, pre-aggregate


def top_airports(size: str):
    return lambda spark, folder: airport_ranking(
        table_flights(spark, folder), STEPS[size], settings_for(size)
    )


def delayed(size: str):
    return lambda spark, folder: delayed_flights(
        table_flights(spark, folder), STEPS[size], settings_for(size)
    )


def full_report(size: str):
    return lambda spark, folder: ranking_text(
        airport_report(table_flights(spark, folder), STEPS[size], settings_for(size))
    )


def all_reports(spark: SparkSession, folder: str) -> DataFrame:
    """The three reports in one go."""
    reports = airport_reports(table_flights(spark, folder), STEPS, DEFAULTS, MIN_FLIGHTS)
    return ranking_text(reports)


def delayed_list_text(spark: SparkSession, folder: str) -> DataFrame:
    """Every airport with flights in the window gets a list, the empty ones too."""
    return airport_lists(table_flights(spark, folder), STEPS["6h"]).select(
        stamp(F.col("ws")).alias("ts"), F.col("origin").alias("origin_airport_id"),
        F.col("severe").alias("severe_delays"), bracketed(F.col("delayed")).alias("delayed_flights"),
    )


def preagg(size: str):
    return lambda spark, folder: airport_preagg(table_flights(spark, folder), WINDOWS_MS[size])


def preagg_top20_text(spark: SparkSession, folder: str) -> DataFrame:
    return airport_preagg_lists(table_flights(spark, folder), WINDOWS_MS["6h"])


def windows_grouped(spark: SparkSession, folder: str) -> DataFrame:
    stats = airport_stats(flown(table_flights(spark, folder)), STEPS["6h"])
    return window_summary(stats, settings_for("6h")).select(
        stamp(F.col("ws")).alias("window_start"), stamp(F.col("we")).alias("window_end"),
        "airports", "qualifying", "flights", "severe_delays",
    )


def q2_run_counts(spark: SparkSession, folder: str) -> DataFrame:
    stats = airport_stats(flown(table_flights(spark, folder)), STEPS["6h"])
    return run_counts(stats, settings_for("6h"))


# Reports from pre-aggregates


def stored_preagg(spark: SparkSession, folder: str, size: str) -> DataFrame:
    path = scratch(spark, f"preagg-{size}")
    write_preagg(airport_preagg(table_flights(spark, folder), WINDOWS_MS[size]), path)
    return read_preagg(spark, path)


def preagg_files_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return stored_preagg(spark, folder, "1h")


def global_from_preagg(spark: SparkSession, folder: str) -> DataFrame:
    stored = airport_preagg(table_flights(spark, folder), WINDOWS_MS["1h"])
    return ranking_report(ranking_from_preagg(stored, whole=True, settings=DEFAULTS))


def post_report(size: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        whole = size == "global"
        stored = stored_preagg(spark, folder, "1h" if whole else size)
        return ranking_text(
            report_from_preagg(stored, table_flights(spark, folder), whole, settings_for(size))
        )

    return run


def post_reports_all(spark: SparkSession, folder: str) -> DataFrame:
    """All reports from pre-aggregates, their lists from one pass over the events."""
    sources = {
        size: (stored_preagg(spark, folder, "1h" if size == "global" else size), size == "global", settings_for(size))
        for size in STEPS
    }
    return ranking_text(reports_from_preagg(sources, table_flights(spark, folder)))


def interval_join_winners(spark: SparkSession, folder: str) -> DataFrame:
    """Winners of all three window sizes in one pass: a flight may fall in several windows."""
    flights = table_flights(spark, folder)
    winners = None
    for size in STEPS:
        stored = airport_preagg(flights, WINDOWS_MS["1h" if size == "global" else size])
        ranked = ranking_from_preagg(stored, size == "global", settings_for(size)).select(
            "ws", "we", "origin"
        )
        winners = ranked if winners is None else winners.unionByName(ranked)
    return flights_in_windows(flights, settle(winners)).select(
        stamp(F.col("ws")).alias("window_start"),
        stamp(F.col("we")).alias("window_end"),
        F.col("origin").alias("airport_id"),
        "seq", "carrier", "dest", "dep_delay",
    )


# Preparation, parsing and scans


def prep_event_time(spark: SparkSession, folder: str) -> DataFrame:
    monthly = table_monthly(table_flights(spark, folder)).drop("event_time")
    return with_event_time(monthly).select(
        "seq", "YEAR", "MONTH", "DAY_OF_MONTH", "CRS_DEP_TIME", "event_time",
        stamp(F.col("event_time")).alias("event_stamp"),
    )


def prep_union_sorted(spark: SparkSession, folder: str) -> DataFrame:
    """Two periods in two file layouts: the second has its columns the other way round, and no
    SECURITY_DELAY."""
    monthly = table_monthly(table_flights(spark, folder))
    names = MONTHLY.fieldNames()
    later = F.col("DAY_OF_MONTH") > 15
    layouts = {
        "2024-01-a": (~later, names),
        "2024-01-b": (later, [n for n in reversed(names) if n != "SECURITY_DELAY"]),
    }
    path = scratch(spark, "monthly")
    for period, (rows, columns) in layouts.items():
        ordered = monthly.where(rows).repartitionByRange("seq").sortWithinPartitions("seq")
        ordered.select(*columns).write.option("header", True).csv(f"{path}/{period}")
    return prepare_events(read_monthly(spark, f"{path}/*", "*.csv", header_per="folder"))


def parsed(parse):
    """Lines, some of them damaged, go through text files as they do in practice."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = scratch(spark, "lines")
        damaged_lines(table_flights(spark, folder)).write.text(path)
        return parse(read_lines(spark, path))

    return run


def _event_file(spark: SparkSession, folder: str) -> str:
    path = scratch(spark, "events")
    write_events(table_monthly(table_flights(spark, folder)), path)
    return path


def scan_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return read_flights(spark, _event_file(spark, folder))


def _plain_csv(spark: SparkSession, folder: str) -> str:
    """The event file as others write it: in event order, without places."""
    path = scratch(spark, "plain-events")
    ordered = table_monthly(table_flights(spark, folder)).orderBy("event_time", "seq")
    ordered.select(*EVENTS.fieldNames()).write.option("header", True).csv(path)
    return path


def scan_csv_plain(spark: SparkSession, folder: str) -> DataFrame:
    """The file's flights, numbered by their composite place."""
    flights = read_flights(spark, _plain_csv(spark, folder))
    return with_position(flights.withColumnRenamed("seq", "place"), ["place"]).drop("place")


def q2_reports_from_plain_csv(spark: SparkSession, folder: str) -> DataFrame:
    flights = read_flights(spark, _plain_csv(spark, folder))
    return ranking_text(airport_reports(flights, STEPS, DEFAULTS, MIN_FLIGHTS))


def scan_csv_tolerant(spark: SparkSession, folder: str) -> DataFrame:
    return read_flights_tolerant(spark, _event_file(spark, folder))


def event_table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "event-table")
    write_event_table(table_monthly(table_flights(spark, folder)), path)
    return spark.read.parquet(path).select(*EVENTS.fieldNames(), "seq")


# Sinks: files read back as lines, in the order of the files and of the lines in them


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of short report files: which file, which line of it (from 1), and its text."""
    lines = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), "*"
    )
    split = lines.select("file", F.posexplode(F.split(F.rtrim("value", F.lit("\n")), "\n")))
    return split.where("col <> ''").select("file", F.col("pos").alias("at"), F.col("col").alias("line"))


def _in_order(lines: DataFrame, *within: str) -> DataFrame:
    """Data lines numbered from 1 as the sorted files hold them, headers left out."""
    order = Window.partitionBy(*within).orderBy("file", "at")
    data = lines.where("at > 0")
    return data.select(*within, F.row_number().over(order).cast("bigint").alias("nth"), "line")


def report_files_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The quoted reports of all windows, line by line."""
    path = scratch(spark, "rankings")
    write_rankings(airport_reports(table_flights(spark, folder), STEPS, DEFAULTS, MIN_FLIGHTS), path)
    lines = _numbered_lines(spark, path)
    return _in_order(lines.withColumn("span", F.regexp_extract("file", "/span=([^/]*)/", 1)), "span")


def post_report_files_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The report from pre-aggregates, quoted by need, line by line."""
    path = scratch(spark, "ranking")
    stored = stored_preagg(spark, folder, "6h")
    write_ranking(report_from_preagg(stored, table_flights(spark, folder), False, settings_for("6h")), path)
    return _in_order(_numbered_lines(spark, path).withColumn("span", F.lit("6h")), "span")


def proc_hour_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Carrier reports below the hour they were written in; the hour itself is left out."""
    path = scratch(spark, "by-hour")
    report = carrier_text(hourly_carrier_stats(table_flights(spark, folder)))
    write_by_hour(report, path)
    return spark.read.schema(report.schema).csv(f"{path}/proc_hour=*")


# Streams


class Replayed:
    """Folders of one streamed query: the feed it reads, its output and its checkpoint."""

    def __init__(self, spark: SparkSession, label: str):
        root = scratch(spark, label)
        self.spark = spark
        self.lines, self.out, self.checkpoint = f"{root}/lines", f"{root}/out", f"{root}/state"
        self.files = 0

    def write(self, folder: str) -> "Replayed":
        events = table_monthly(table_flights(self.spark, folder))
        self.files = write_replay(events, self.lines, close=True)
        return self

    def stream(self) -> DataFrame:
        return stream_lines(self.spark, self.lines, -(-self.files // MICRO_BATCHES))

    def csv(self, stream: DataFrame) -> DataFrame:
        finish(to_csv(stream, self.out, self.checkpoint))
        return self.spark.read.schema(stream.schema).csv(self.out)

    def per_batch(self, stream: DataFrame, report) -> DataFrame:
        finish(each_batch(stream, self.out, self.checkpoint, report))
        return self.spark.read.parquet(self.out).drop("batch")


def stream_q1(spark: SparkSession, folder: str) -> DataFrame:
    replayed = Replayed(spark, "q1").write(folder)
    return replayed.csv(carrier_stream(replayed.stream()))


def stream_q1_late(spark: SparkSession, folder: str) -> DataFrame:
    """Cancelled flights are reported only after all others; their closed hours stay as they are."""
    events = table_monthly(table_flights(spark, folder))
    late = F.col("CANCELLED") >= 1.0
    replayed = Replayed(spark, "q1-late")
    # The stream source needs its folder to exist.
    to_lines(events.limit(0)).write.text(replayed.lines)
    report = carrier_stream(stream_lines(spark, replayed.lines))
    phases = [to_lines(events.where(~late)), to_lines(events.where(late)), end_line(spark)]
    feed(phases, replayed.lines, lambda: to_csv(report, replayed.out, replayed.checkpoint))
    return spark.read.schema(report.schema).csv(replayed.out)


def stream_q1_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """The feed comes in two stretches of time, a run of the stream after each, then its end."""
    events = table_monthly(table_flights(spark, folder))
    middle = events.agg(F.expr("percentile_approx(event_time, 0.5)")).first()[0]
    replayed = Replayed(spark, "q1-resumed")
    to_lines(events.limit(0)).write.text(replayed.lines)
    report = carrier_stream(stream_lines(spark, replayed.lines))
    early = F.col("event_time") < middle
    for lines in (to_lines(events.where(early)), to_lines(events.where(~early)), end_line(spark)):
        lines.write.mode("append").text(replayed.lines)
        replayed.csv(report)
    return spark.read.schema(report.schema).csv(replayed.out)


def stream_preagg(size: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        replayed = Replayed(spark, f"preagg-{size}").write(folder)
        return replayed.csv(preagg_report(airport_stream(replayed.stream(), WINDOWS_MS[size])))

    return run


def stream_q2_top_airports_6h(spark: SparkSession, folder: str) -> DataFrame:
    replayed = Replayed(spark, "ranking").write(folder)
    stats = airport_stream(replayed.stream(), WINDOWS_MS["6h"])
    settings = settings_for("6h")
    return replayed.per_batch(
        stats, lambda batch: ranking_report(rank_airports(batch, settings))
    )


def stream_top20(size: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        replayed = Replayed(spark, f"worst-{size}").write(folder)
        worst = worst_flights_stream(replayed.stream(), WINDOWS_MS[size])
        return replayed.per_batch(worst, merge_candidates).select(
            stamp(F.col("ws")).alias("window_start"),
            stamp(F.col("we")).alias("window_end"),
            F.col("origin").alias("airport_id"),
            "place", "carrier", "dest", "dep_delay",
        )

    return run


def _all_sizes(spark: SparkSession, folder: str, label: str, stream) -> DataFrame:
    """One query over the lines that feeds a folder for each window length, read back together."""
    replayed = Replayed(spark, label).write(folder)
    report = stream(replayed.stream())
    folders = {size: f"{replayed.out}/{size}" for size in WINDOWS_MS}
    finish(start_with_rocksdb(spark, lambda: to_folders(report, "span", folders, replayed.checkpoint)))
    columns = report.drop("span").schema
    parts = [
        spark.read.schema(columns).csv(f"{path}/batch=*").withColumn("span", F.lit(size))
        for size, path in folders.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def stream_preagg_all_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return _all_sizes(
        spark, folder, "preagg-all",
        lambda lines: preagg_report(airport_spans_stream(lines, WINDOWS_MS), F.col("span")),
    )


def stream_preagg_lists_all_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return _all_sizes(
        spark, folder, "lists-all",
        lambda lines: preagg_report(
            airport_lists_stream(lines, WINDOWS_MS), piped(F.col("delayed")).alias("top_str"), F.col("span")
        ),
    ).fillna("", ["top_str"])


def stream_q2_preagg_top20_6h(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and list from one state, as the eighth column of the pre-aggregate's files."""
    replayed = Replayed(spark, "preagg-list").write(folder)
    listed = airport_lists_stream(replayed.stream(), {"6h": WINDOWS_MS["6h"]})
    report = preagg_report(listed, piped(F.col("delayed")).alias("top_str"))
    finish(start_with_rocksdb(spark, lambda: to_csv(report, replayed.out, replayed.checkpoint)))
    return spark.read.schema(report.schema).csv(replayed.out).fillna("", ["top_str"])


def stream_then_post_6h(spark: SparkSession, folder: str) -> DataFrame:
    """Pre-aggregates from the stream's files, lists from the events."""
    replayed = Replayed(spark, "stream-post").write(folder)
    replayed.csv(preagg_report(airport_stream(replayed.stream(), WINDOWS_MS["6h"])))
    stored = read_preagg(spark, replayed.out)
    flights = table_flights(spark, folder)
    return ranking_text(report_from_preagg(stored, flights, settings=settings_for("6h")))


QUERIES = {
    "q1_hourly_carrier_stats": q1_hourly_carrier_stats,
    "q1_report_text": q1_report_text,
    **{f"q2_top_airports_{size}": top_airports(size) for size in STEPS},
    **{f"q2_delayed_flights_{size}": delayed(size) for size in STEPS},
    **{f"q2_report_{size}": full_report(size) for size in STEPS},
    "q2_reports_all": all_reports,
    "q2_delayed_list_text": delayed_list_text,
    **{f"q2_preagg_{size}": preagg(size) for size in WINDOWS_MS},
    "q2_preagg_top20_text": preagg_top20_text,
    "q2_windows_grouped": windows_grouped,
    "q2_run_counts": q2_run_counts,
    "preagg_files_roundtrip": preagg_files_roundtrip,
    "q2_global_from_preagg": global_from_preagg,
    "q2_post_report_6h": post_report("6h"),
    "q2_post_report_global": post_report("global"),
    "q2_post_reports_all": post_reports_all,
    "q2_interval_join_winners": interval_join_winners,
    "prep_event_time": prep_event_time,
    "prep_union_sorted": prep_union_sorted,
    "parse_lines_q1": parsed(parse_carrier_flights),
    "parse_lines_q2": parsed(parse_airport_flights),
    "parse_lines_full": parsed(parse_events),
    "scan_csv_roundtrip": scan_csv_roundtrip,
    "scan_csv_tolerant": scan_csv_tolerant,
    "scan_csv_plain": scan_csv_plain,
    "q2_reports_from_plain_csv": q2_reports_from_plain_csv,
    "event_table_roundtrip": event_table_roundtrip,
    "report_files_roundtrip": report_files_roundtrip,
    "post_report_files_roundtrip": post_report_files_roundtrip,
    "proc_hour_roundtrip": proc_hour_roundtrip,
    "stream_q1": stream_q1,
    "stream_q1_late": stream_q1_late,
    "stream_q1_resumed": stream_q1_resumed,
    **{f"stream_q2_preagg_{size}": stream_preagg(size) for size in WINDOWS_MS},
    "stream_q2_top_airports_6h": stream_q2_top_airports_6h,
    **{f"stream_q2_top20_{size}": stream_top20(size) for size in WINDOWS_MS},
    "stream_preagg_all_sizes": stream_preagg_all_sizes,
    "stream_preagg_lists_all_sizes": stream_preagg_lists_all_sizes,
    "stream_q2_preagg_top20_6h": stream_q2_preagg_top20_6h,
    "stream_then_post_6h": stream_then_post_6h,
}
