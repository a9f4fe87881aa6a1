"""The five jobs, from monthly files to reports. Paths are folders every executor can reach."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.lists import piped
from tarmac.functions.numbers import two_decimals
from tarmac.operators.airports import preagg_report, rank_airports, ranking_report
from tarmac.operators.carriers import carrier_text
from tarmac.plans.airports import airport_reports
from tarmac.plans.postprocess import reports_from_preagg
from tarmac.plans.prepare import prepare_events
from tarmac.session import settle, ship_package
from tarmac.settings import DEFAULTS, WINDOWS_MS, Settings
from tarmac.sinks.files import ranking_text, write_event_table, write_events, write_ranking, write_rankings
from tarmac.sources.files import (
    read_event_table,
    read_flights,
    read_flights_tolerant,
    read_monthly,
    read_preagg,
)
from tarmac.sources.lines import stream_lines
from tarmac.streaming.lists import airport_lists_stream
from tarmac.streaming.replay import close_lines
from tarmac.streaming.reports import airport_stream, carrier_stream
from tarmac.streaming.sinks import finish, refuse_after_end, to_csv, to_folders
from tarmac.streaming.spans import airport_spans_stream, start_with_rocksdb

# The windows of the airport reports and the folders of the pre-aggregates.
REPORT_SPANS = {"1h": WINDOWS_MS["1h"], "6h": WINDOWS_MS["6h"], "global": None}
PREAGG_FOLDERS = {"q2_1h": "1h", "q2_6h": "6h", "q2_global": "120d"}


def prepare(
    spark: SparkSession, input_dir: str, output: str, glob: str = "2025*.csv",
    table: bool = False,
) -> None:
    """Monthly files -> one event file in event order (Parquet by day if `table`)."""
    events = prepare_events(read_monthly(spark, input_dir, glob))
    (write_event_table if table else write_events)(events, output)


def carriers_by_hour(
    spark: SparkSession, lines: str, output: str, checkpoint: str,
    settings: Settings = DEFAULTS, files_per_trigger: int | None = None, by_hour: bool = False,
    every: str | None = None, close: bool = False,
) -> None:
    """Event lines -> hourly carrier statistics, appended as CSV.

    Stops when all lines are read, and goes on from there when run again; with `every` (say
    "30 seconds") it keeps waiting for more. `close` ends the feed, so that the last hours come out
    too; from then on, a run that finds new lines raises ClosedStreamError and reads none of them.
    """
    refuse_after_end(spark, lines, checkpoint)
    if close:
        close_lines(spark, lines)
    report = carrier_text(carrier_stream(stream_lines(spark, lines, files_per_trigger), settings))
    finish(to_csv(report, output, checkpoint, by_hour, every))


def airports(
    spark: SparkSession, events: str, output: str, settings: Settings = DEFAULTS,
    blank_flags: str = "drop", table: bool = False,
) -> None:
    """Event file (or `table`) -> the airport reports of all windows, a folder per window.

    A flight with a blank flag is left out; blank_flags="keep" counts it as flown, as the
    streaming jobs do.
    """
    flights = (read_event_table if table else read_flights)(spark, events)
    if blank_flags == "drop":
        flights = flights.dropna(subset=["cancelled", "diverted"])
    write_rankings(airport_reports(flights, REPORT_SPANS, settings), output)


def preaggregate(
    spark: SparkSession, lines: str, output_root: str, checkpoint: str,
    settings: Settings = DEFAULTS, files_per_trigger: int | None = None, lists: bool = False,
    every: str | None = None, close: bool = False,
) -> None:
    """Event lines -> per-(window, airport) statistics for 1 h, 6 h and 120 days.

    One query reads the lines for all three; each window has a folder with a part for every
    micro-batch that closed some. `lists` adds the worst flights of each as an eighth column. `close`
    ends the feed, as for carriers_by_hour.
    """
    refuse_after_end(spark, lines, checkpoint)
    if close:
        close_lines(spark, lines)
    ship_package(spark)
    source = stream_lines(spark, lines, files_per_trigger)
    spans = {folder: WINDOWS_MS[size] for folder, size in PREAGG_FOLDERS.items()}
    if lists:
        stats = airport_lists_stream(source, spans, settings)
        report = preagg_report(stats, piped(F.col("delayed")).alias("top_str"), F.col("span"))
    else:
        report = preagg_report(airport_spans_stream(source, spans, settings), F.col("span"))
    report = report.withColumns({n: two_decimals(n) for n in ("sum_delay", "max_delay")})
    folders = {folder: f"{output_root}/{folder}" for folder in spans}
    finish(start_with_rocksdb(spark, lambda: to_folders(report, "span", folders, checkpoint, every)))


def top_airports(
    spark: SparkSession, lines: str, output: str, checkpoint: str, size: str = "6h",
    settings: Settings = DEFAULTS, files_per_trigger: int | None = None,
    every: str | None = None, close: bool = False,
) -> None:
    """Event lines -> the top airports of each window as it closes, as CSV below batch folders.

    `size` is a key of WINDOWS_MS; `close` ends the feed, as for carriers_by_hour.
    """
    refuse_after_end(spark, lines, checkpoint)
    if close:
        close_lines(spark, lines)
    stats = airport_stream(stream_lines(spark, lines, files_per_trigger), WINDOWS_MS[size], settings)

    def report(batch: DataFrame) -> DataFrame:
        return ranking_text(ranking_report(rank_airports(batch, settings))).withColumn("span", F.lit(size))

    finish(to_folders(stats, "span", {size: output}, checkpoint, every, report))


def postprocess(
    spark: SparkSession, preagg_root: str, events: str, output_root: str,
    settings: Settings = DEFAULTS,
) -> list[str]:
    """Pre-aggregates and the event file -> the airport reports, from one pass over the events.

    Returns the reports written; a window size without pre-aggregates has none.
    """
    sources = {}
    for name, folder, whole in (
        ("q2_1h_final", "q2_1h", False),
        ("q2_6h_final", "q2_6h", False),
        ("q2_global_final", "q2_1h", True),
    ):
        stored = _stored_preagg(spark, f"{preagg_root}/{folder}")
        if stored is not None:
            sources[name] = stored, whole, settings
    if sources:
        # The reports are short: at most `top_k` rows for each window.
        reports = settle(reports_from_preagg(sources, read_flights_tolerant(spark, events), settings))
        for name in sources:
            write_ranking(reports.where(F.col("report") == name).drop("report"), f"{output_root}/{name}")
    return list(sources)


def _stored_preagg(spark: SparkSession, path: str) -> DataFrame | None:
    """The pre-aggregates below `path`, or None where the stream has left none."""
    try:
        stored = read_preagg(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if stored.isEmpty() else stored
