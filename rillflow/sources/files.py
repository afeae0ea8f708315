"""Text lines and landed JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow import schemas
from rillflow.functions import payloads, times


def text_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One ``value`` row per line, from a bounded or a growing folder."""
    reader = spark.readStream if stream else spark.read
    return reader.format("text").load(path)


def landed_records(
    spark: SparkSession, path: str, feed: str, stream: bool = False
) -> DataFrame:
    """JSON records of a feed from files someone else lands, one record per line.

    Read as text and decoded with the feed's own rules, so files and topics agree.
    """
    decoded = payloads.decode(text_lines(spark, path, stream), schemas.FEEDS[feed])
    if "date" in decoded.columns:
        return decoded.withColumn("date", times.parse_instant(F.col("date")))
    return decoded
