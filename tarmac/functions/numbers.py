"""Number parsing, safe division and two-decimal text, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text a strict reader accepts as a number, blanks around it aside. Spark's own cast ignores
# those blanks too, but is laxer otherwise (it takes "1.5d").
_BLANK_TEXT = r"^\s*$"
_FLOAT_TEXT = (
    r"^\s*[+-]?(?:\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
)
_INT_TEXT = r"^\s*[+-]?\d+\s*$"


def float_or_zero(text: Column) -> Column:
    """Blank is 0.0; a number is itself; anything else is NULL."""
    return F.when(text.rlike(_FLOAT_TEXT), text.try_cast("double")).when(
        text.rlike(_BLANK_TEXT), F.lit(0.0)
    )


def strict_int(text: Column, kind: str = "int") -> Column:
    """Whole-number text only: "11298.0" and blank are NULL."""
    return F.when(text.rlike(_INT_TEXT), text.try_cast(kind))


def lenient_int(text: Column, kind: str = "int") -> Column:
    """Any number, cut to a whole one; blank is 0."""
    return float_or_zero(text).try_cast(kind)


def number_or_zero(value: Column) -> Column:
    """NULL and NaN read as 0.0."""
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, or 0.0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def two_decimals(name: str) -> Column:
    """The named column as text with two decimals, see `two_decimals_sql`."""
    return F.expr(two_decimals_sql(name)).alias(name)


def two_decimals_sql(name: str) -> str:
    """The SQL of a number (named, possibly inside of a struct) as text with two decimals, rounded from its exact binary value.

    Ties go to even, as printf does: 0.125 is 0.12 and 2.675 is 2.67, where Spark's own formatting
    rounds the shortest decimal half-up (0.13 and 2.68). size * 100 is kept as head + tail without
    error (the tail from a Dekker split of the size), so the rounding sees the exact number.
    Values of 1e13 and more have no such room to spare and are far outside any delay. Infinite
    values and NaN print as inf, -inf and nan.
    """
    size = f"abs({name})"
    spread = f"({size} * 134217729D)"
    high = f"({spread} - ({spread} - {size}))"
    head = f"({size} * 100D)"
    tail = f"(({high} * 100D - {head}) + ({size} - {high}) * 100D)"
    whole = f"floor({head})"
    rest = f"({head} - {whole})"
    up = (
        f"{rest} > 0.5D OR ({rest} = 0.5D AND "
        f"({tail} > 0D OR ({tail} = 0D AND pmod({whole}, 2) = 1)))"
    )
    return (
        f"CASE WHEN isnan({name}) THEN 'nan' WHEN {size} = double('inf') "
        f"THEN if({name} < 0D, '-inf', 'inf') ELSE concat(if({name} < 0D, '-', ''), "
        f"format_string('%.2f', if({up}, {whole} + 1, {whole}) / 100D)) END"
    )
