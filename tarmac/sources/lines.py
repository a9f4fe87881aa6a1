"""Event lines: one comma-separated flight per line, 17 fields or more, no quoting, no header."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.numbers import float_or_zero, lenient_int, strict_int
from tarmac.schema import EVENTS
from tarmac.settings import DEFAULTS, Settings

WIDTH = len(EVENTS)
# Marks the line that ends a bounded replay; it only moves event time forward.
END_CARRIER = "~end"
END_MS = 253_370_764_800_000  # 9999-01-01


def _split(lines: DataFrame) -> DataFrame:
    """The fields of each line; shorter lines are dropped, extra fields kept.

    Blanks at the line ends stay: they can only touch number fields, which ignore them.
    """
    parts = F.split("value", ",")
    return lines.select(F.explode(F.array(parts)).alias("f")).where(F.size("f") >= WIDTH)


def _convert(parts: DataFrame, columns: dict[str, Column], needed: list[str]) -> DataFrame:
    """Convert each line once and keep those whose needed fields are readable ("nan" is).

    The conversion is a one-row generator, as is the split above. A filter on plain projected
    columns would move below the projection with a copy of every conversion, and of the split,
    for each column it tests: many times the work per line.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    readable = functools.reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in needed])
    return parts.select(F.inline(F.array(row))).where(readable)


def _field(name: str) -> Column:
    return F.get("f", F.lit(EVENTS.fieldNames().index(name)))


def _seq() -> Column:
    """A field after the fixed ones may carry the flight's place in the stream."""
    return strict_int(F.get("f", F.lit(WIDTH)), "bigint")


def _flag(name: str) -> Column:
    """A flag that reads "nan" is not set (Spark would order NaN above 1)."""
    return F.nanvl(float_or_zero(_field(name)), F.lit(0.0))


def parse_carrier_flights(
    lines: DataFrame, settings: Settings = DEFAULTS, keep_end: bool = False
) -> DataFrame:
    """Flights of the reported carriers; lines with an unreadable number are dropped."""
    wanted = [*settings.carriers, END_CARRIER] if keep_end else list(settings.carriers)
    parts = _split(lines).where(_field("OP_UNIQUE_CARRIER").isin(wanted))
    columns = {
        "carrier": _field("OP_UNIQUE_CARRIER"),
        "dep_delay": float_or_zero(_field("DEP_DELAY")),
        "cancelled": _flag("CANCELLED"),
        "diverted": _flag("DIVERTED"),
        "event_time": strict_int(_field("event_time"), "bigint"),
        "seq": _seq(),
    }
    return _convert(parts, columns, ["dep_delay", "cancelled", "diverted", "event_time"])


def parse_airport_flights(lines: DataFrame, keep_end: bool = False) -> DataFrame:
    """Flown flights (neither cancelled nor diverted) of all carriers, with their airports."""
    parts = _split(lines)
    if not keep_end:
        parts = parts.where(_field("OP_UNIQUE_CARRIER") != END_CARRIER)
    columns = {
        "origin": strict_int(_field("ORIGIN_AIRPORT_ID")),
        "carrier": _field("OP_UNIQUE_CARRIER"),
        "dest": strict_int(_field("DEST_AIRPORT_ID")),
        "dep_delay": float_or_zero(_field("DEP_DELAY")),
        "cancelled": _flag("CANCELLED"),
        "diverted": _flag("DIVERTED"),
        "event_time": strict_int(_field("event_time"), "bigint"),
        "seq": _seq(),
    }
    flights = _convert(parts, columns, [n for n in columns if n not in ("carrier", "seq")])
    return flights.where((F.col("cancelled") < 1.0) & (F.col("diverted") < 1.0)).drop(
        "cancelled", "diverted"
    )


def parse_events(lines: DataFrame) -> DataFrame:
    """All 17 columns, typed leniently: "11298.0" is a whole number, blank is 0."""
    columns = {}
    for field in EVENTS:
        text, kind = _field(field.name), field.dataType.simpleString()
        if kind == "string":
            columns[field.name] = text
        elif kind == "double":
            columns[field.name] = float_or_zero(text)
        else:
            columns[field.name] = lenient_int(text, kind)
    return _split(lines).select(*[column.alias(name) for name, column in columns.items()])


def to_lines(events: DataFrame, seq: str | None = "seq") -> DataFrame:
    """Events as text lines in the fixed column order; NULL is blank."""
    names = [*EVENTS.fieldNames(), *([seq] if seq else [])]
    texts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names]
    return events.select(F.concat_ws(",", *texts).alias("value"))


def end_line(spark: SparkSession) -> DataFrame:
    """The line that closes every open window of a bounded replay."""
    # YEAR..DAY, carrier, origin, dest, CRS_DEP_TIME, then nine numbers, event_time.
    value = ",".join(["9999", "1", "1", END_CARRIER, "-1", "-1", "0", *["0"] * 9, str(END_MS)])
    return spark.range(0, 1, 1, 1).select(F.lit(value).alias("value"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the files that appear under `path`, oldest file first."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a running feeder. One reader and no replay after a failure: for trials only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
