"""Parquet output split by year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.functions import times


def with_year(df: DataFrame, date: str = "date") -> DataFrame:
    """Add the year of a ``yyyy-MM-dd`` text column as the folder key."""
    return df.withColumn("year", F.year(times.to_day(F.col(date))))


def write_by_year(df: DataFrame, path: str, date: str = "date", mode: str = "append") -> None:
    """One ``year=...`` folder per year, so reads of a year skip the others."""
    with_year(df, date).write.mode(mode).partitionBy("year").parquet(path)
