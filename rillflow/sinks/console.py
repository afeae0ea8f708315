"""Print rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def print_rows(df: DataFrame, rows: int = 20) -> None:
    """The first ``rows`` rows."""
    df.show(rows, truncate=False)


def print_stream(
    df: DataFrame, name: str, mode: str = "append", rows: int = 20, **trigger
) -> StreamingQuery:
    """The first ``rows`` rows of every micro-batch."""
    writer = df.writeStream.format("console").queryName(name).outputMode(mode)
    return writer.option("truncate", "false").option("numRows", rows).trigger(
        **(trigger or {"processingTime": "5 seconds"})
    ).start()
