"""Kafka output. Needs the Kafka connector on the cluster's class path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillflow.functions import payloads


def sink_options(
    servers: str,
    topic: str,
    linger_ms: int | None = None,
    batch_bytes: int | None = None,
    compression: str | None = None,
) -> dict[str, str]:
    """Writer options. Delivery is at least once."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if linger_ms is not None:
        options["kafka.linger.ms"] = str(linger_ms)
    if batch_bytes is not None:
        options["kafka.batch.size"] = str(batch_bytes)
    if compression is not None:
        options["kafka.compression.type"] = compression
    return options


def json_message(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A row's columns as a JSON message. Event times stay in the payload, in UTC."""
    return payloads.object_row(
        F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(name)
        if dtype == "timestamp"
        else F.col(name)
        for name, dtype in df.select(*(columns or df.columns)).dtypes
    )


def as_messages(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as JSON messages in ``value``."""
    return df.select(json_message(df, columns).alias("value"))


def publish(df: DataFrame, options: Mapping[str, str]) -> None:
    """Write a batch of ``value`` rows to a topic."""
    df.select("value").write.format("kafka").options(**options).save()


def stream_to_topic(
    df: DataFrame, options: Mapping[str, str], name: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Write a stream of ``value`` rows to a topic."""
    return (
        df.select("value").writeStream.format("kafka").options(**options)
        .queryName(name).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


