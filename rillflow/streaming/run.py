"""Starting queries: names, checkpoints and triggers in one place."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rillflow.plans.shared import same_layout

BOUNDED = {"availableNow": True}
# How often state and offsets are secured, as in the jobs this follows (fixed value).
STEADY = {"processingTime": "120 seconds"}


@contextmanager
def state_per_core(spark: SparkSession) -> Iterator[None]:
    """Start a stateful query with one state partition per core of the cluster.

    The number is fixed by a query's first start, and every partition costs a state
    store and a Python worker per batch, whether it holds keys or not.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def start(
    df: DataFrame,
    name: str,
    checkpoint_root: str,
    sink: Callable[[DataFrame, int], None],
    mode: str = "append",
    trigger: dict | None = None,
    layout: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Run ``sink`` on every micro-batch.

    The name fixes the checkpoint folder, so a restarted query goes on where it was.
    ``layout`` names what its state hangs on, such as ``{"salts": 8}``; it is kept beside the
    checkpoint, and a restart with another one fails.
    """
    if layout is not None:
        same_layout(df.sparkSession, f"{checkpoint_root}/{name}-layout", layout)
    return (
        df.writeStream.queryName(name)
        .option("checkpointLocation", f"{checkpoint_root}/{name}")
        .outputMode(mode)
        .trigger(**(trigger or STEADY))
        .foreachBatch(sink)
        .start()
    )


def start_parquet(
    df: DataFrame,
    name: str,
    checkpoint_root: str,
    path: str,
    trigger: dict | None = None,
    layout: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Append to a Parquet folder, exactly once; ``layout`` as in :func:`start`."""
    if layout is not None:
        same_layout(df.sparkSession, f"{checkpoint_root}/{name}-layout", layout)
    return (
        df.writeStream.queryName(name)
        .option("checkpointLocation", f"{checkpoint_root}/{name}")
        .outputMode("append")
        .trigger(**(trigger or STEADY))
        .format("parquet").start(path)
    )
