"""Price lines to monthly price records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.functions import lines, times


def drop_headers(rows: DataFrame, value: str = "value") -> DataFrame:
    """Keep the data lines of text input."""
    return rows.filter(~lines.is_header(F.col(value)))


def _checked(rows: DataFrame, value: str) -> DataFrame:
    # Exploding an array of one record is a step that filters above it can't be moved below,
    # so a line is split once and its record computed once.
    split = rows.withColumn("_fields", lines.fields(F.col(value)))
    record = split.select(
        *rows.columns, F.explode(F.array(lines.price_struct(F.col("_fields")))).alias("_price")
    )
    needed = [F.col(f"_price.{name}") for name in ("open", "high", "low", "close", "volume")]
    valid = times.to_day(F.col("_price.date")).isNotNull()
    for column in needed:
        valid = valid & column.isNotNull()
    return record.withColumn("_valid", valid)


def parse_prices(
    rows: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Data lines to price columns; a line that cannot be read fails the job.

    The check sits in a filter, so it also runs when no price column is used later.
    ``keep`` names other columns of ``rows`` to carry along.
    """
    failure = F.raise_error(F.concat(F.lit("not a price line: "), F.col(value))).cast("boolean")
    return (
        _checked(drop_headers(rows, value), value)
        .filter(F.when(F.col("_valid"), True).otherwise(failure))
        .select("_price.*", *keep)
    )


def divert_prices(rows: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Data lines to (price columns, lines that cannot be read)."""
    checked = _checked(drop_headers(rows, value), value)
    return (
        checked.filter("_valid").select("_price.*"),
        checked.filter("NOT _valid").select(value),
    )


def with_month(prices: DataFrame, date: str = "date", month: str = "month") -> DataFrame:
    """Add the month key: the first day of the record's month as text."""
    return prices.withColumn(month, times.month_start(times.to_day(F.col(date))))


def month_record(averages: DataFrame, month: str = "month", average: str = "average") -> DataFrame:
    """Name the output columns of a monthly average."""
    return averages.select(F.col(month).alias("date"), F.col(average).alias("average"))
