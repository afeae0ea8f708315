"""The customer lookup table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rillflow import schemas


def jdbc_options(
    url: str,
    table: str = "customers",
    user: str | None = None,
    password: str | None = None,
    column: str = "id",
    lower: int = 0,
    upper: int = 1_000_000,
    partitions: int = 8,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a parallel JDBC read: one range of ``column`` per partition.

    The bounds only shape the ranges; rows outside them are read as well.
    """
    options = {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def jdbc_lookup(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Lookup read over JDBC, afresh in every micro-batch."""
    return spark.read.format("jdbc").options(**options).load()


def parquet_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Lookup kept as Parquet. Its file list is fixed here, so call it per batch."""
    return spark.read.schema(schemas.CUSTOMER).parquet(path)
