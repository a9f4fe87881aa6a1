"""Sinks for the streaming reports.

A query stops once all available input is read, or goes on if given an interval (`every`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.settings import DAY_MS
from tarmac.sources.lines import END_MS

#: Watermarks from here on (as progress reports print them) come from the end line.
CLOSED = "9998"
CLOSED_MS = END_MS - DAY_MS


class ClosedStreamError(RuntimeError):
    """Lines came to a query whose event time had been ended."""


def refuse_after_end(spark: SparkSession, lines: str, checkpoint: str) -> None:
    """Raise if `lines` has files that a query, whose event time has been ended, has not read.

    Looked up in the query's checkpoint before it is started, so that nothing is consumed.
    """
    def logged(folder: str) -> DataFrame | None:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/{folder}")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.read.text(path.toString())

    offsets, sources = logged("offsets"), logged("sources/0")
    if offsets is None or sources is None:
        return
    mark = F.get_json_object("value", "$.batchWatermarkMs").cast("bigint")
    if (offsets.agg(F.max(mark)).first()[0] or 0) < CLOSED_MS:
        return

    def plain(name) -> Column:
        return F.regexp_replace(name, "^file:/+", "/")

    read = sources.select(plain(F.get_json_object("value", "$.path")).alias("path"))
    there = spark.read.format("binaryFile").load(lines).select(plain(F.col("path")).alias("path"))
    if count := there.join(read, "path", "left_anti").count():
        raise ClosedStreamError(
            f"{count} files came after the end of the stream and are not read; "
            "read the feed again with a new checkpoint"
        )


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query; raise if it read lines after the one that ends event time.

    Such lines are late, whatever their time, and would be dropped without a word.
    """
    query.awaitTermination()
    for progress in query.recentProgress:
        mark = (progress["eventTime"] or {}).get("watermark", "")
        if progress["numInputRows"] and mark >= CLOSED:
            raise ClosedStreamError(
                f"{progress['numInputRows']} lines came after the end of the stream; "
                "read the feed again with a new checkpoint"
            )
    return query


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def to_csv(
    stream: DataFrame, path: str, checkpoint: str, by_hour: bool = False, every: str | None = None
) -> StreamingQuery:
    """Append CSV part files without header, exactly once per row.

    `by_hour` files them below the processing hour, e.g. proc_hour=2026-06-30--16.
    """
    if by_hour:
        hour = F.date_format(F.current_timestamp(), "yyyy-MM-dd--HH")
        stream = stream.withColumn("proc_hour", hour)
    writer = stream.writeStream.format("csv").outputMode("append")
    if by_hour:
        writer = writer.partitionBy("proc_hour")
    return (
        writer.option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every)).start()
    )


def each_batch(
    stream: DataFrame, path: str, checkpoint: str, report: Callable[[DataFrame], DataFrame],
    every: str | None = None,
) -> StreamingQuery:
    """Apply a batch-only step (a ranking, say) to the rows of each micro-batch.

    All rows of a window leave the aggregation in the same micro-batch, so a per-window step sees
    the window whole. A repeated micro-batch overwrites its own folder; one without rows has none.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if rows := _settled(report(batch)):
            rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            rows.unpersist()

    return _started(stream, write, checkpoint, every)


def to_folders(
    stream: DataFrame, by: str, folders: dict[str, str], checkpoint: str, every: str | None = None,
    report: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """One query, several sinks: CSV files without header, in the folder that `by` names.

    `report` is a batch-only step on what closed. A micro-batch is computed once and dealt out; each folder gets a `batch=<n>` folder for it, if it
    has rows for it. A repeated micro-batch overwrites its own.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if rows := _settled(report(batch)):
            there = {row[0] for row in rows.select(by).distinct().collect()}
            for value in sorted(there):
                part = rows.where(F.col(by) == value).drop(by)
                part.write.mode("overwrite").csv(f"{folders[value]}/batch={batch_id}")
            rows.unpersist()

    return _started(stream, write, checkpoint, every)


def _settled(rows: DataFrame) -> DataFrame | None:
    """The rows, kept while they are written; None if there are none."""
    rows = rows.persist()
    if not rows.isEmpty():
        return rows
    rows.unpersist()


def _started(stream: DataFrame, write, checkpoint: str, every: str | None) -> StreamingQuery:
    return (
        stream.writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()
    )


def all_of(starts: dict[str, Callable[[], StreamingQuery]]) -> dict[str, StreamingQuery]:
    """Start one query per window size over the same lines and wait for all of them."""
    queries = {name: start() for name, start in starts.items()}
    for query in queries.values():
        finish(query)
    return queries
