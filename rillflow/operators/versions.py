"""Newest-version and latest-value reads over append-only tables.

All of them keep one row per key with ``max`` over a struct, which reduces each key
to one row per task before the shuffle, however many copies the key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow import schemas
from rillflow.functions import times


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the greatest ``by`` values per key.

    Equal ``by`` values are settled by the remaining columns, so the result does not
    depend on how the input is spread.
    """
    if columns is None:
        columns = [name for name in df.columns if name not in (*keys, *by)]
    rest = [name for name in columns if name not in by]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*by, *rest)).alias("_newest"))
    return newest.select(*keys, *[F.col(f"_newest.{name}") for name in (*by, *rest)])


def newest_version(
    df: DataFrame, keys: Sequence[str] = schemas.SERVING_KEYS, version: str = "version"
) -> DataFrame:
    """One row per key: the one with the highest version."""
    return latest_by(df, keys, [version]).select(*df.columns)


def newest_version_ranked(
    df: DataFrame, keys: Sequence[str] = schemas.SERVING_KEYS, version: str = "version"
) -> DataFrame:
    """Same result by rank; Spark cuts each task's rows to rank 1 before the shuffle."""
    rest = sorted(name for name in df.columns if name not in (*keys, version))
    order = [F.col(name).desc() for name in (version, *rest)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def consistent_read(table: DataFrame, version: str = "version") -> DataFrame:
    """A serving table as if all older versions were gone.

    Keys compare event times to the millisecond, as the tables store them. Filters on
    the key columns given to the result reach the scan.
    """
    stored = table.withColumn("date", times.to_millis(F.col("date")))
    return newest_version(stored, schemas.SERVING_KEYS, version)
