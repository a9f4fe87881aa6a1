"""CSV files with a header: monthly flight files, the event file, and pre-aggregates."""

from __future__ import annotations

import os
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.numbers import float_or_zero, number_or_zero, strict_int
from tarmac.schema import EVENTS, FLIGHT_COLUMNS, MONTHLY, PREAGG

# Where a row came from: file, split of the file, row. In this order they sort the rows as the files
# hold them, however the files were split.
SOURCE = ("src_file", "src_block", "src_row")


def list_files(spark: SparkSession, path: str, glob: str) -> list[str]:
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
    )
    return sorted(row.path for row in files.collect())


def _layouts(
    spark: SparkSession, files: list[str], header_per: str
) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header, so that one scan reads all files of a layout."""
    groups: dict[str, list[str]] = {}
    for file in files:
        groups.setdefault(file if header_per == "file" else file.rsplit("/", 1)[0], []).append(file)
    members = list(groups.values())
    with ThreadPool(min(16, len(members))) as pool:
        headers = pool.map(
            lambda group: tuple(spark.read.option("header", True).csv(group[0]).columns), members
        )
    layouts: dict[tuple[str, ...], list[str]] = {}
    for header, group in zip(headers, members):
        layouts.setdefault(header, []).extend(group)
    return layouts


def _tail(files: list[str]) -> int:
    """How many last parts of their paths tell the files apart, and order them."""
    parts = [file.split("/") for file in files]
    shared = os.path.commonprefix([p[:-1] for p in parts])
    return max(len(p) for p in parts) - len(shared)


def _source(tail: int) -> list[Column]:
    """The SOURCE columns. Row ids grow within a split; a compressed file is a single split."""
    return [
        F.substring_index("_metadata.file_path", "/", -tail).alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_row"),
    ]


def _typed(header: tuple[str, ...], known: T.StructType) -> T.StructType:
    types = {field.name: field.dataType for field in known}
    return T.StructType([T.StructField(name, types.get(name, T.StringType())) for name in header])


def read_monthly(
    spark: SparkSession, directory: str, glob: str = "2025*.csv", with_source: bool = True,
    header_per: str = "file",
) -> DataFrame:
    """UNION ALL, by column name, of the monthly files; columns a file lacks are NULL.

    Fails when no file matches. Each row carries its source place unless told otherwise.
    Headers are looked up per file, which suits a file per month. Where a month is a folder of
    many parts, header_per="folder" looks at one part of each; in both cases Spark compares
    every file's header while reading and fails on a difference.
    """
    files = list_files(spark, directory, glob)
    if not files:
        raise FileNotFoundError(f"no file matches {glob} in {directory}")
    # hhmm may be written as 1230 or 1230.0, so it is read as a double first.
    known = T.StructType(
        [
            T.StructField(f.name, T.DoubleType() if f.name == "CRS_DEP_TIME" else f.dataType)
            for f in MONTHLY
        ]
    )
    months: DataFrame | None = None
    for header, paths in _layouts(spark, files, header_per).items():
        scan = (
            spark.read.option("header", True).option("enforceSchema", False)
            .option("mode", "FAILFAST").schema(_typed(header, known)).csv(paths)
        )
        wanted = [field.name for field in MONTHLY if field.name in header]
        month = scan.select(*wanted, *(_source(_tail(files)) if with_source else []))
        months = month if months is None else months.unionByName(month, allowMissingColumns=True)
    for field in MONTHLY:
        column = F.col(field.name) if field.name in months.columns else F.lit(None)
        months = months.withColumn(field.name, column.cast(field.dataType))
    return months.select(*MONTHLY.fieldNames(), *(SOURCE if with_source else ()))


def _event_scan(spark: SparkSession, path: str, as_text: bool) -> DataFrame:
    """All parts of one event file share a header; Spark checks each part against it.

    Read as numbers, a field that is none ends the read; blank is NULL.
    """
    first = spark.read.option("header", True).csv(path).columns
    known = T.StructType([*EVENTS.fields, T.StructField("seq", T.LongType())])
    if as_text:
        known = T.StructType([])
    return (
        spark.read.option("header", True).option("enforceSchema", False)
        .option("mode", "PERMISSIVE" if as_text else "FAILFAST")
        .schema(_typed(tuple(first), known)).csv(path)
    )


def _with_seq(flights: DataFrame) -> DataFrame:
    """Event files from elsewhere have no `seq`: time and source place together take its part.

    They order flights as numbers would, through every ranking and list, without counting first;
    `with_position` makes numbers of them where numbers are wanted.
    """
    if "seq" in flights.columns:
        return flights
    return flights.withColumn("seq", F.struct("event_time", *SOURCE)).drop(*SOURCE)


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """The flight columns of a typed event file, with `seq`, its place in event order."""
    scan = _event_scan(spark, path, as_text=False)
    place = [F.col("seq")] if "seq" in scan.columns else _source(1)
    names = [F.col(name).alias(new) for name, new in FLIGHT_COLUMNS.items()]
    return _with_seq(scan.select(*names, *place))


def read_event_table(spark: SparkSession, path: str) -> DataFrame:
    """The flight columns of an event table; filters and columns reach its Parquet scan."""
    names = [F.col(name).alias(new) for name, new in FLIGHT_COLUMNS.items()]
    return spark.read.parquet(path).select(*names, "seq")


def read_flights_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """The same columns from any event file; rows that fail to convert are skipped."""
    scan = _event_scan(spark, path, as_text=True)
    as_read = {
        "carrier": F.col("OP_UNIQUE_CARRIER"),
        "origin": strict_int(F.col("ORIGIN_AIRPORT_ID")),
        "dest": strict_int(F.col("DEST_AIRPORT_ID")),
        "event_time": strict_int(F.col("event_time"), "bigint"),
    }
    numbers = {
        new: float_or_zero(F.coalesce(F.col(name), F.lit("")))
        for name, new in FLIGHT_COLUMNS.items()
        if new in ("dep_delay", "cancelled", "diverted")
    }
    needed = [*numbers, "origin", "dest", "event_time"]
    if "seq" in scan.columns:
        place = [strict_int(F.col("seq"), "bigint").alias("seq")]
    else:
        place = _source(1)
    flights = scan.select(*[c.alias(n) for n, c in {**as_read, **numbers}.items()], *place)
    flights = _with_seq(flights.dropna(subset=needed))
    return flights.withColumns(
        {name: number_or_zero(F.col(name)) for name in ("cancelled", "diverted")}
    )


def read_preagg(spark: SparkSession, directory: str) -> DataFrame:
    """Pre-aggregate lines of all finished part files below `directory`.

    Only lines with the seven fixed fields, or these plus the list text, are taken.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
        .text(directory).where(~F.col("_metadata.file_path").contains(".inprogress"))
    )
    width = len(PREAGG)
    parts = lines.select(F.split("value", ",", width + 1).alias("f")).where(
        F.size("f").isin(width, width + 1)
    )
    columns = [
        F.get("f", F.lit(i)).cast(field.dataType).alias(field.name)
        for i, field in enumerate(PREAGG)
    ]
    return parts.select(*columns)
