"""Averages per key: running, total, and at the end of each active spell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.plans.blocks import BLOCK, HOT, across_blocks, block_window, plan_blocks


def total_average(
    df: DataFrame, keys: Sequence[str], value: str, out: str = "average"
) -> DataFrame:
    """One average per key; partial sums are formed before the shuffle."""
    return df.groupBy(*keys).agg(F.avg(value).alias(out))


def partial_sums(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The (count, sum) state behind the averages; sums of parts add up."""
    return df.groupBy(*keys).agg(F.count(value).alias("count"), F.sum(value).alias("sum"))


def running_average(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: str,
    out: str = "average",
    block_rows: int | None = None,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Average of a key's values so far as a double, one output row per input row.

    ``order`` must tell the rows of one key apart. ``opening`` gives what keys start
    from, as the (count, sum) of :func:`partial_sums`.
    """
    plan = plan_blocks(df, keys, order, block_rows)
    if plan is None and opening is None:
        so_far = (
            Window.partitionBy(*keys).orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return df.withColumn(out, F.avg(F.col(value).cast("double")).over(so_far))
    rows = df.withColumns({
        "_row": F.lit(1),
        "_sum": F.col(value).cast("double"),
        "_count": F.col(value).isNotNull().cast("long"),
    })
    if opening is not None:
        # An opening has no place in the order, so it sorts first and into block 1.
        first = opening.select(
            *keys,
            F.lit(0).alias("_row"),
            F.col("sum").alias("_sum"),
            F.col("count").alias("_count"),
        )
        rows = rows.unionByName(first, allowMissingColumns=True)
    if plan is None:
        rows = rows.withColumn(BLOCK, F.lit(0).cast("long"))
    else:
        rows = plan.tag(rows)
        earlier = across_blocks(keys).rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            rows.filter(HOT)
            .groupBy(*keys, BLOCK)
            .agg(F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"))
            .select(
                *keys, BLOCK, F.lit(0).alias("_row"),
                F.sum("_sum").over(earlier).alias("_sum"),
                F.sum("_count").over(earlier).alias("_count"),
            )
            .filter(F.col("_count").isNotNull())
        )
        rows = rows.unionByName(carried, allowMissingColumns=True)
    so_far = block_window(keys, "_row", order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    average = F.try_divide(F.sum("_sum").over(so_far), F.sum("_count").over(so_far))
    return rows.withColumn(out, average).filter("_row = 1").select(*df.columns, out)


def inactivity_average(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    event_time: str,
    gap_seconds: float = 5.0,
    out: str = "average",
    block_rows: int | None = None,
) -> DataFrame:
    """Average so far, given out wherever a key then stays silent for longer than the gap.

    The sum is never reset, so a key may appear many times; its last record always
    counts as followed by silence. Rows without a time are left out. Output: keys, event
    time of the last record, average.
    """
    moments = moments_of(df, keys, value, event_time)
    return silences(moments, keys, event_time, gap_seconds, out, block_rows)


def moments_of(df: DataFrame, keys: Sequence[str], value: str, event_time: str) -> DataFrame:
    """The (_sum, _count) of every key and time; records of one key and time act together."""
    return df.filter(F.col(event_time).isNotNull()).groupBy(*keys, event_time).agg(
        F.sum(F.col(value).cast("double")).alias("_sum"), F.count(value).alias("_count")
    )


def silences(
    moments: DataFrame,
    keys: Sequence[str],
    event_time: str,
    gap_seconds: float,
    out: str = "average",
    block_rows: int | None = None,
    opening: DataFrame | None = None,
    until: int | None = None,
) -> DataFrame:
    """The average so far after every moment that is followed by silence.

    ``moments`` are those of :func:`moments_of`. ``opening`` gives what keys start from, as the
    (count, sum) of :func:`partial_sums`. With ``until``, in microseconds, only moments count
    whose gap ended before it; the others are there to end a silence.
    """
    plan = plan_blocks(moments, keys, event_time, block_rows)
    spread = moments.withColumn("_row", F.lit(1))
    if opening is not None:
        # An opening has no time, so it sorts first and into a key's first block.
        spread = spread.unionByName(opening.select(
            *keys, F.lit(None).cast(moments.schema[event_time].dataType).alias(event_time),
            F.col("sum").alias("_sum"), F.col("count").alias("_count"), F.lit(0).alias("_row"),
        ))
    if plan is None:
        window = Window.partitionBy(*keys).orderBy("_row", event_time)
    else:
        tagged = plan.tag(spread)
        blocks = (
            tagged.filter(HOT)
            .groupBy(*keys, BLOCK)
            .agg(
                F.sum("_sum").alias("_sum"),
                F.sum("_count").alias("_count"),
                F.min(event_time).alias("_first"),
            )
        )
        earlier = across_blocks(keys).rowsBetween(Window.unboundedPreceding, -1)
        edges = blocks.select(
            *keys, BLOCK,
            F.sum("_sum").over(earlier).alias("_sum"),
            F.sum("_count").over(earlier).alias("_count"),
            F.lead("_first").over(across_blocks(keys)).alias("_next"),
        )
        # Before a block: what earlier blocks sum to. After it: when the key goes on.
        before = edges.select(*keys, BLOCK, "_sum", "_count", F.lit(0).alias("_row"))
        after = edges.filter(F.col("_next").isNotNull()).select(
            *keys, BLOCK, F.col("_next").alias(event_time), F.lit(2).alias("_row")
        )
        window = block_window(keys, "_row", event_time)
        spread = (
            tagged
            .unionByName(before.filter(F.col("_count").isNotNull()), allowMissingColumns=True)
            .unionByName(after, allowMissingColumns=True)
        )
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gap = F.lit(int(gap_seconds * 1_000_000))
    silence = F.unix_micros("_following") - F.unix_micros(event_time)
    given = F.col("_following").isNull() | (silence > gap)
    if until is not None:
        given = given & (F.unix_micros(event_time) + gap < F.lit(until))
    return (
        spread.withColumns({
            out: F.try_divide(F.sum("_sum").over(so_far), F.sum("_count").over(so_far)),
            "_following": F.lead(event_time).over(window),
        })
        .filter("_row = 1")
        .filter(given)
        .select(*keys, event_time, out)
    )
