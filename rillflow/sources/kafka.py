"""Kafka topics as DataFrames. Needs the Kafka connector on the cluster's class path."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow import schemas
from rillflow.functions import keys, payloads, times

# Kafka's own codes for the two ends of a partition (fixed values).
EARLIEST = -2
LATEST = -1


def parse_partitions(text: str | None) -> list[int] | None:
    """``"0, 2"`` to [0, 2]; None means all partitions."""
    if text is None:
        return None
    return [int(part) for part in text.split(",") if part.strip()]


def start_position(
    topic: str,
    to: str | int = "beginning",
    partitions: Iterable[int] | None = None,
    other_partitions: Mapping[int, int] | None = None,
    partition_count: int | None = None,
) -> str:
    """Value of ``startingOffsets``: "beginning", "end" or an offset.

    Kafka reads want an entry for every partition, so a choice of partitions comes with
    the offsets of the others. An offset for all partitions comes with their number.
    A start position counts only for a query without a checkpoint.
    """
    if to not in ("beginning", "end") and not isinstance(to, int):
        raise ValueError("to must be 'beginning', 'end' or an offset")
    if partitions is None:
        if isinstance(to, int) and partition_count is None:
            raise ValueError("an explicit offset needs the partitions or their number")
        if isinstance(to, int):
            return json.dumps({topic: {str(part): to for part in range(partition_count)}})
        return "earliest" if to == "beginning" else "latest"
    code = {"beginning": EARLIEST, "end": LATEST}.get(to, to)
    offsets = {str(part): offset for part, offset in (other_partitions or {}).items()}
    offsets.update({str(part): code for part in partitions})
    return json.dumps({topic: dict(sorted(offsets.items(), key=lambda item: int(item[0])))})


def source_options(
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str = "earliest",
    max_offsets: int | None = None,
    committed_only: bool = True,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options. Offsets live in the query's checkpoint, so none are committed."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if committed_only:
        options["kafka.isolation.level"] = "read_committed"
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    options.update(extra or {})
    return options


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A topic as a stream of Kafka rows."""
    return spark.readStream.format("kafka").options(**options).load()


def reread_topic(
    spark: SparkSession, options: Mapping[str, str], ending: str = "latest"
) -> DataFrame:
    """A bounded range of a topic as a batch."""
    bounded = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    return spark.read.format("kafka").options(**bounded, endingOffsets=ending).load()


def strings(rows: DataFrame) -> DataFrame:
    """Message values of Kafka rows as text."""
    return rows.select(F.col("value").cast("string").alias("value"))


def with_version(rows: DataFrame) -> DataFrame:
    """Message text, record version and Kafka time of Kafka rows."""
    return rows.select(
        F.col("value").cast("string").alias("value"),
        keys.record_version(F.col("partition"), F.col("offset")).alias("version"),
        F.col("timestamp").alias("kafka_time"),
    )


def typed_records(rows: DataFrame, feed: str) -> DataFrame:
    """Decoded records of a feed without telemetry dates or metadata."""
    return payloads.decode(strings(rows), schemas.FEEDS[feed])


def versioned_records(rows: DataFrame, feed: str) -> DataFrame:
    """Decoded telemetry; ``version`` comes from the Kafka row, not from the payload."""
    decoded = payloads.decode(with_version(rows), schemas.FEEDS[feed], keep=["version"])
    return decoded.withColumn("date", times.parse_instant(F.col("date")))


def ordered_drivers(rows: DataFrame) -> DataFrame:
    """Decoded driver records, with ``kafka_time`` and then ``order`` (offset) as arrival order.

    The version tells records apart but doesn't date them: it counts partitions first.
    """
    ordered = rows.select(
        F.col("value").cast("string").alias("value"),
        keys.record_version(F.col("partition"), F.col("offset")).alias("version"),
        F.col("timestamp").alias("kafka_time"), F.col("offset").alias("order"),
    )
    return payloads.decode(ordered, schemas.DRIVER_FEED, keep=["version", "kafka_time", "order"])
