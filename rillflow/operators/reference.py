"""Joining telemetry to reference records that may arrive after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow import schemas
from rillflow.plans.blocks import BLOCK, HOT, across_blocks, block_window, plan_blocks
from rillflow.plans.sizing import BROADCAST_ROWS

# Reference records per key up to which each telemetry row may look at all of them.
LOOKUP_VERSIONS = 64


def reference_join(
    telemetry: DataFrame,
    reference: DataFrame,
    keys: Sequence[str] = schemas.DRIVER_KEYS,
    columns: Sequence[str] = schemas.DRIVER_COLUMNS,
    arrival: str = "arrival",
    held: str | None = None,
    block_rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    lookup_versions: int = LOOKUP_VERSIONS,
) -> DataFrame:
    """Telemetry with the reference columns known when each row arrived.

    A row that arrived before its key's first reference record gets that first record
    (it was held, then released). Rows whose key never gets one are not given out.
    Each telemetry row appears at most once. ``arrival`` orders both inputs; ``held``
    names an optional flag column for the rows that had to wait. No arrival means before
    everything, on either side.
    """
    records = _one_per_arrival(reference, keys, columns, arrival)
    known = telemetry.dropna(subset=list(keys))
    per_key = records.groupBy(*keys).count()
    size = per_key.agg(F.sum("count").alias("total"), F.max("count").alias("most")).first()
    if (size.total or 0) <= broadcast_rows and (size.most or 0) <= lookup_versions:
        joined = _by_interval(known, records, keys, arrival)
    else:
        joined = _by_scan(known, records, keys, arrival, block_rows)
    output = [F.col(name) for name in telemetry.columns]
    output += [F.col(f"_record.{name}").alias(name) for name in columns]
    if held:
        waited = F.col("_since").isNotNull() & (
            F.col(arrival).isNull() | (F.col("_since") > F.col(arrival))
        )
        output.append(waited.alias(held))
    return joined.select(*output)


def _one_per_arrival(
    reference: DataFrame, keys: Sequence[str], columns: Sequence[str], arrival: str
) -> DataFrame:
    record = F.struct(*columns)
    return (
        reference.dropna(subset=list(keys))
        .groupBy(*keys, F.col(arrival).alias("_since"))
        .agg(F.max(record).alias("_record"))
    )


def _by_interval(
    telemetry: DataFrame, records: DataFrame, keys: Sequence[str], arrival: str
) -> DataFrame:
    """Broadcast each record with its validity interval; telemetry is not shuffled.

    Only for record tables of checked size. A key's intervals do not overlap, and the
    first one reaches back without bound, so every row meets exactly one.
    """
    timeline = Window.partitionBy(*keys).orderBy("_since")
    first = F.row_number().over(timeline) == 1
    intervals = records.select(
        *[F.col(key).alias(f"_{key}") for key in keys],
        "_since",
        "_record",
        F.when(~first, F.col("_since")).alias("_from"),
        F.lead("_since").over(timeline).alias("_until"),
    )
    at = F.col(arrival)
    # No arrival counts as before everything, as in an ordered pass.
    opening = F.col("_from").isNull()
    condition = (opening | (at >= F.col("_from"))) & (
        F.col("_until").isNull() | (at < F.col("_until")) | (at.isNull() & opening)
    )
    for key in keys:
        condition = condition & (F.col(key) == F.col(f"_{key}"))
    return telemetry.join(F.broadcast(intervals), condition, "inner")


def _by_scan(
    telemetry: DataFrame,
    records: DataFrame,
    keys: Sequence[str],
    arrival: str,
    block_rows: int | None,
) -> DataFrame:
    """Both sides in one ordered pass per key, in blocks where a key is hot."""
    entry = F.struct("_since", "_record").alias("_entry")
    telling = records.select(
        *keys, F.col("_since").alias(arrival), entry, F.lit(1).alias("_row")
    )
    both = telemetry.withColumn("_row", F.lit(2)).unionByName(telling, allowMissingColumns=True)
    firsts = records.groupBy(*keys).agg(F.min(F.struct("_since", "_record")).alias("_entry"))
    plan = plan_blocks(both.select(*keys, arrival), keys, arrival, block_rows)
    if plan is None:
        spread = both.withColumn(BLOCK, F.lit(0).cast("long"))
        openings = firsts.withColumn(BLOCK, F.lit(0).cast("long"))
    else:
        spread = plan.tag(both, "_row")
        # Last record of every block, then the last one before each block.
        lasts = (
            spread.filter(HOT)
            .groupBy(*keys, BLOCK)
            .agg(F.max("_entry").alias("_last"))
        )
        earlier = across_blocks(keys).rowsBetween(Window.unboundedPreceding, -1)
        carried = lasts.select(*keys, BLOCK, F.max("_last").over(earlier).alias("_carried"))
        # A block without an earlier record opens with the key's first one.
        hot_openings = carried.join(firsts, list(keys)).select(
            *keys, BLOCK, F.coalesce("_carried", "_entry").alias("_entry")
        )
        cold_firsts = firsts.join(plan.hot, list(keys), "left_anti")
        openings = cold_firsts.withColumn(BLOCK, F.lit(0).cast("long")).unionByName(hot_openings)
    spread = spread.unionByName(
        openings.withColumn("_row", F.lit(0)), allowMissingColumns=True
    )
    # Openings have no arrival, so they sort first.
    so_far = block_window(keys, arrival, "_row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        spread.withColumn("_entry", F.last("_entry", ignorenulls=True).over(so_far))
        .filter((F.col("_row") == 2) & driver_known(F.col("_entry")))
        .select(
            *telemetry.columns,
            F.col("_entry._since").alias("_since"),
            F.col("_entry._record").alias("_record"),
        )
    )


def driver_known(record: Column) -> Column:
    """Route on this: true rows go out, the others are held."""
    return record.isNotNull()


def rows_waiting(
    telemetry: DataFrame, reference: DataFrame, keys: Sequence[str] = schemas.DRIVER_KEYS
) -> DataFrame:
    """Telemetry still waiting for a reference record of its key."""
    return telemetry.join(reference.select(*keys).distinct(), list(keys), "left_anti")


def of_known_drivers(
    telemetry: DataFrame,
    drivers: DataFrame,
    keys: Sequence[str] = ("session_key", "driver_number"),
) -> DataFrame:
    """Telemetry of the given drivers; a driver without telemetry just adds no rows."""
    return telemetry.join(drivers.select(*keys).distinct(), list(keys), "left_semi")


def of_session(df: DataFrame, session_key: int, meeting_key: int) -> DataFrame:
    """Records of one session; the filter reaches the scan."""
    return df.filter(
        (F.col("session_key") == F.lit(session_key)) & (F.col("meeting_key") == F.lit(meeting_key))
    )


def with_event_date(df: DataFrame, strict: bool = False, date: str = "date") -> DataFrame:
    """Drop records without an event date, or fail on them when ``strict``."""
    present = F.col(date).isNotNull()
    if strict:
        failure = F.raise_error(F.lit("record is missing its event date")).cast("boolean")
        return df.filter(F.when(present, True).otherwise(failure))
    return df.filter(present)


def enriched_row(joined: DataFrame, feed: str) -> DataFrame:
    """Joined telemetry in the column order of its serving table."""
    return joined.select(*schemas.SERVING[feed].fieldNames())
