"""Delimited text lines to typed price columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_PREFIX = "date"


def is_header(line: Column) -> Column:
    """True for header lines, wherever in a file they stand."""
    return F.lower(line).startswith(HEADER_PREFIX)


def fields(line: Column) -> Column:
    """The comma-separated fields of a line; there is no quoting."""
    return F.split(line, ",")


def strict_int(text: Column) -> Column:
    """Digits with an optional sign to int; null for anything else or out of range."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def price_struct(parts: Column) -> Column:
    """One price record from the fields of a line; null where a field cannot be read.

    The volume comes from column 5, or from column 6 where 5 is no int.
    """
    prices = [
        F.get(parts, F.lit(position)).try_cast("double").alias(name)
        for position, name in enumerate(("open", "high", "low", "close"), start=1)
    ]
    volume = F.coalesce(strict_int(F.get(parts, F.lit(5))), strict_int(F.get(parts, F.lit(6))))
    return F.struct(F.get(parts, F.lit(0)).alias("date"), *prices, volume.alias("volume"))
