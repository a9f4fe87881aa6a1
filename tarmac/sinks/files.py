"""File sinks for events and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.numbers import two_decimals
from tarmac.schema import EVENTS


def write_events(events: DataFrame, path: str) -> None:
    """The event file: parts in event order, each with a header and sorted inside.

    `seq` is kept as a last column; readers by name or by position may ignore it.
    """
    ordered = events.select(*EVENTS.fieldNames(), "seq").orderBy("event_time", "seq")
    ordered.write.option("header", True).csv(path)


def write_event_table(events: DataFrame, path: str) -> None:
    """The events as Parquet, a folder per day and sorted inside, for windowed reads at scale.

    The range split is on (day, time, place), so one busy day still spreads over many files.
    """
    day = F.to_date(F.timestamp_millis("event_time"))
    (
        events.withColumn("event_date", day)
        .repartitionByRange("event_date", "event_time", "seq")
        .sortWithinPartitions("event_date", "event_time", "seq")
        .write.partitionBy("event_date").parquet(path)
    )


def ranking_text(report: DataFrame) -> DataFrame:
    """The ranking as published: mean and maximum as two-decimal text."""
    rounded = ("dep_delay_mean", "dep_delay_max")
    return report.withColumns({name: two_decimals(name) for name in rounded})


def write_ranking(report: DataFrame, path: str, single_file: bool = False) -> None:
    """The airport report with a header, windows ascending and ranks inside.

    Sorted parts read in name order give the same lines as one file; `single_file` merges them
    and suits the short reports (ten rows per window) only.
    """
    ordered = ranking_text(report).orderBy("ts", "rank")
    if single_file:
        ordered = ordered.coalesce(1)
    ordered.write.option("header", True).csv(path)


def write_rankings(reports: DataFrame, path: str) -> None:
    """Reports of several windows in one go: a folder per `span`, each in order.

    The list is always quoted here, the empty one too. The CSV writer quotes by need or
    everything, so it gets finished lines as its only column, named after the header. A missing
    value is an empty field.
    """
    order = ["span", "ts", "rank"]
    names = [name for name in reports.columns if name != "span"]
    texts = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names}
    texts["delayed_flights"] = F.concat(F.lit('"'), texts["delayed_flights"], F.lit('"'))
    fields = list(texts.values())
    (
        ranking_text(reports).repartitionByRange(*order).sortWithinPartitions(*order)
        .select("span", F.concat_ws(",", *fields).alias(",".join(names)))
        .write.partitionBy("span").option("header", True)
        .option("sep", "\x01").option("escapeQuotes", False).csv(path)
    )


def write_preagg(preagg: DataFrame, path: str) -> None:
    """Part files named .csv, one line per (window, airport), no header.

    The seven plain fields, then the list text where there is one.
    """
    texts = {name: two_decimals(name) for name in ("sum_delay", "max_delay")}
    preagg.withColumns(texts).write.option("emptyValue", "").csv(path)


def write_by_hour(df: DataFrame, path: str) -> None:
    """Append below a folder named after the processing hour, e.g. 2026-06-30--16."""
    hour = F.date_format(F.current_timestamp(), "yyyy-MM-dd--HH")
    df.withColumn("proc_hour", hour).write.mode("append").partitionBy("proc_hour").csv(path)
