"""Join keys and record versions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Room for offsets inside one partition's version range (fixed value).
PARTITION_STRIDE = 1_000_000_000_000


def record_version(partition: Column, offset: Column) -> Column:
    """Version of a record, unique across the partitions of a topic.

    It identifies a record rather than dating it: the same row replayed to a lower
    partition gets a lower version.
    """
    return partition.cast("long") * F.lit(PARTITION_STRIDE) + offset.cast("long")


def join_key(*parts: Column) -> Column:
    """Composite key as text. Joins here use the columns themselves instead."""
    return F.concat_ws("|", *[part.cast("string") for part in parts])
