"""Ordered per-key work that survives hot keys.

A window partitioned by key runs each key in one task, so a key with a third of all rows would
not scale. Here the rows of keys above ``block_rows`` rows are dealt by ranges of (key, order)
and cut into blocks of at most ``block_rows`` rows. A window then runs per (key, block), and what
a block needs from the others (a running sum, the last known value) enters as one extra row per
block, found by a second scan over one summary row per block. Rows of equal order are told apart
by a hash of the whole row, so they part into blocks like all others. Keys below the bound stay
whole, no row is dropped, and neither keys nor bounds pass through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.plans.shared import keys_as, same_keys, written

BLOCK = "_block"
HOT = "_hot"
BLOCK_ROWS = 4_000_000
#: Rows that one task of a range deal sorts, about; it may cut them into many blocks.
TASK_ROWS = 4_000_000
#: Bits that monotonically_increasing_id gives to the row within its task (a fixed value).
_ROW_BITS = 33


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame | None:
    """The keys with more than ``rows`` rows and their number ``_rows``, or None if there are none.

    A written table of at most count / ``rows`` rows: Spark's own size check decides how it is
    joined.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    found = written(counts.filter(F.col("_rows") > rows), "hot-keys")
    return None if found.isEmpty() else found


@dataclass(frozen=True)
class BlockPlan:
    """Which keys are cut, along which column, and into how many tasks."""

    keys: tuple[str, ...]
    order: str
    hot: DataFrame
    block_rows: int
    tasks: int

    def tag(self, df: DataFrame, *then: str) -> DataFrame:
        """Add whether the key is hot, and its block: 0 for whole keys, else from 1 on.

        Blocks follow the order column (null first) and then the columns ``then``.
        """
        marks, on = keys_as(self.hot, self.keys, "_hot_"), same_keys(self.keys, "_hot_")
        order = [*self.keys, self.order, *then]
        tie = F.xxhash64(*df.columns)
        dealt = (
            df.join(marks, on, "left_semi")
            .repartitionByRange(self.tasks, *order, tie)
            .sortWithinPartitions(*order, tie)
            .withColumn("_place", F.monotonically_increasing_id())
        )
        task = F.shiftright("_place", _ROW_BITS)
        place = F.col("_place") - F.shiftleft(task, _ROW_BITS)
        block = F.shiftleft(task, _ROW_BITS) + F.floor(place / self.block_rows) + 1
        blocks = written(
            dealt.withColumns({HOT: F.lit(True), BLOCK: block.cast("long")}).drop("_place"), "blocks"
        )
        whole = df.join(marks, on, "left_anti").withColumns(
            {HOT: F.lit(False), BLOCK: F.lit(0).cast("long")}
        )
        return whole.unionByName(blocks)


def plan_blocks(
    df: DataFrame, keys: Sequence[str], order: str, block_rows: int | None = None
) -> BlockPlan | None:
    """Look for hot keys; None means every key may stay whole.

    Costs one counting pass over the key columns.
    """
    block_rows = block_rows or BLOCK_ROWS
    kind = df.schema[order].dataType
    if not isinstance(kind, (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"order column {order!r} must be integral or a time, not {kind}")
    hot = hot_keys(df, keys, block_rows)
    if hot is None:
        return None
    total = hot.agg(F.sum("_rows")).first()[0]
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return BlockPlan(tuple(keys), order, hot, block_rows, max(least, -(-total // TASK_ROWS)))


def block_window(keys: Sequence[str], *order: Column | str):
    """Rows of one (key, block) in order."""
    return Window.partitionBy(*keys, BLOCK).orderBy(*order)


def across_blocks(keys: Sequence[str]):
    """Block summaries of one key in order: its rows / ``block_rows``, and two per task more."""
    return Window.partitionBy(*keys).orderBy(BLOCK)
