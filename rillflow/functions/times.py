"""Dates, instants and their text forms. All times are UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLIS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"

# An ISO date-time needs a date, a "T" and a time; fraction and offset are optional.
INSTANT_PATTERN = (
    r"(?i)^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
    r"(Z|[+-]\d{2}(:\d{2}(:\d{2})?)?)?$"
)
OFFSET_PATTERN = r"(?i)(Z|[+-]\d{2}(:\d{2}(:\d{2})?)?)$"


def to_day(text: Column) -> Column:
    """``yyyy-MM-dd`` text to a date; null when it is no such date."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def month_start(day: Column) -> Column:
    """First day of the month, as ``yyyy-MM-dd`` text."""
    return F.trunc(day, "month").cast("string")


def year_text(day: Column) -> Column:
    return F.year(day).cast("string")


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def parse_instant(text: Column, strict: bool = True) -> Column:
    """ISO date-time text to a timestamp.

    A missing offset means UTC and blank text gives null. Other text raises when
    ``strict``, else gives null.
    """
    zoned = F.when(text.rlike(OFFSET_PATTERN), text).otherwise(F.concat(text, F.lit("Z")))
    parsed = F.when(text.rlike(INSTANT_PATTERN), F.upper(zoned).try_cast("timestamp"))
    if not strict:
        return parsed
    failure = F.raise_error(F.concat(F.lit("not an ISO date-time: "), text)).cast("timestamp")
    return F.when(blank_to_null(text).isNull(), F.lit(None)).otherwise(
        F.coalesce(parsed, failure)
    )


def format_millis(instant: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS``, truncated; null stays null."""
    return F.date_format(instant, MILLIS_FORMAT)


def to_millis(instant: Column) -> Column:
    """Drop what lies below the millisecond."""
    return F.date_trunc("millisecond", instant)


def trimmed_fraction(instant: Column) -> Column:
    """Seconds with a fraction of at least one digit and no trailing zeros beyond it."""
    return F.regexp_replace(
        F.date_format(instant, "yyyy-MM-dd HH:mm:ss.SSSSSS"), "0{1,5}$", ""
    )


def epoch_millis(instant: Column) -> Column:
    return F.unix_millis(instant)


def playback_offset(instant: Column, first: Column, speed: float) -> Column:
    """Seconds after the start at which a record is due when replayed at ``speed``."""
    if speed <= 0:
        raise ValueError("speed must be greater than 0")
    return (F.unix_micros(instant) - F.unix_micros(first)) / F.lit(1e6) / F.lit(float(speed))
