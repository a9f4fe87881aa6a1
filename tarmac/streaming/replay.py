"""Replaying events in order as a stream of line files."""

from __future__ import annotations

import time
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tarmac.settings import DAY_MS
from tarmac.sources.lines import end_line, to_lines


def write_replay(
    events: DataFrame, path: str, files: int | None = None, close: bool = False
) -> int:
    """Write the events as line files, one stretch of event time each, and return their number.

    One range-partitioned pass, by default into as many files as a shuffle has partitions. The
    stream source reads the oldest file first, so the files get modification times in event order
    afterwards (tasks finish in any order). `close` adds the line that makes the stream emit its
    last windows, see `close_lines`.
    """
    spark = events.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = events.repartitionByRange(files, "event_time", "seq").sortWithinPartitions(
        "event_time", "seq"
    )
    to_lines(ordered).write.text(path)
    written = _date_in_order(spark, path)
    if close:
        close_lines(spark, path)
    return written


def close_lines(spark: SparkSession, path: str) -> None:
    """End the event time of a feed for good: the next run emits the last windows.

    A query that has read this line counts everything later as late, so it refuses to go on
    (`streaming.sinks.finish`). Start again from a new checkpoint to read a feed that grew.
    """
    end_line(spark).write.mode("append").text(path)


def _date_in_order(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    # Part numbers have five digits or more, so longer names come later.
    named = sorted((len(name), name) for name in names if name.startswith("part-"))
    apart = min(1000, DAY_MS // max(1, len(named)))  # the source skips files a week older
    first = int(time.time() * 1000) - apart * len(named)

    def date(nth: int) -> None:
        part = spark._jvm.org.apache.hadoop.fs.Path(folder, named[nth][1])
        system.setTimes(part, first + apart * nth, -1)

    with ThreadPool(16) as pool:
        pool.map(date, range(len(named)))
    return len(named)


def feed(phases: list[DataFrame], path: str, start: Callable[[], StreamingQuery]) -> None:
    """Deliver each frame of lines in turn and let the stream take it in before the next.

    `start` resumes the same query (one checkpoint) and stops when nothing is left to read.
    """
    for lines in phases:
        lines.write.mode("append").text(path)
        start().awaitTermination()
