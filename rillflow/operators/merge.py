"""Several telemetry feeds as one list in event-time order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.functions import times


def tag_and_union(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """All rows of all feeds with their topic; columns a feed lacks are null."""
    merged = None
    for topic, feed in feeds.items():
        tagged = feed.withColumn("topic", F.lit(topic))
        merged = (
            tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
        )
    if merged is None:
        raise ValueError("no feeds given")
    return merged


def in_event_time(
    merged: DataFrame, event_time: str = "date", sequence: str = "sequence"
) -> DataFrame:
    """Global order by event time; topic and sequence settle ties.

    A range-partitioned sort: equal times may be split over tasks.
    """
    return merged.orderBy(event_time, "topic", sequence)


def with_schedule(
    merged: DataFrame, speed: float, event_time: str = "date"
) -> DataFrame:
    """Add the event time in epoch milliseconds and the playback offset in seconds.

    The first event time is a scalar subquery, one value however large the input.
    """
    first = merged.agg(F.min(event_time)).scalar()
    at = F.col(event_time)
    return merged.withColumns({
        "event_millis": times.epoch_millis(at),
        "offset_seconds": times.playback_offset(at, first, speed),
    })
