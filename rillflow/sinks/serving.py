"""Versioned serving tables: append everything, let readers keep the newest."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow import schemas
from rillflow.functions import times


def _name(table: str, database: str | None) -> str:
    return f"{database}.{table}" if database else table


def create_tables(
    spark: SparkSession, database: str | None = None, location: str | None = None
) -> None:
    """Create the four tables where they are missing. This never alters a table."""
    for table, schema in schemas.SERVING.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        statement = (
            f"CREATE TABLE IF NOT EXISTS {_name(table, database)} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(schemas.SERVING_PARTITIONS)})"
        )
        if location:
            statement += f" LOCATION '{location}/{table}'"
        spark.sql(statement)


def drop_tables(spark: SparkSession, database: str | None = None) -> None:
    for table in schemas.SERVING:
        spark.sql(f"DROP TABLE IF EXISTS {_name(table, database)}")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns and types of the serving table; event times to the millisecond.

    A missing or surplus column is an error, and so is a number out of range.
    """
    schema = schemas.SERVING[table]
    wrong = set(df.columns) ^ set(schema.fieldNames())
    if wrong:
        raise ValueError(f"columns differ from table {table}: {sorted(wrong)}")
    columns = []
    for field in schema.fields:
        column = F.col(field.name).cast(field.dataType)
        if field.name == "date":
            column = times.to_millis(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def check_table(spark: SparkSession, table: str, database: str | None = None) -> None:
    """Fail when an existing table has other columns than its declared schema."""
    actual = {f.name: f.dataType for f in spark.table(_name(table, database)).schema}
    declared = {f.name: f.dataType for f in schemas.SERVING[table]}
    if actual != declared:
        raise ValueError(f"table {table} does not match its schema; drop and recreate it")


def sort_keys(table: str) -> list[str]:
    return list(schemas.DRIVER_KEYS if table == "drivers" else schemas.SERVING_KEYS)


def in_key_ranges(df: DataFrame, table: str) -> DataFrame:
    """Rows sorted for key lookups, for tables that are written once and read often.

    Ranges are cut over the whole sort key, so a session with most of the rows is
    written by many tasks, each with a narrow range of keys per file. To find the ranges
    Spark runs the input a second time.
    """
    keys = sort_keys(table)
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def laid_out(df: DataFrame, table: str) -> DataFrame:
    """Rows of a partition together, for appends: the input runs once.

    Adaptive execution splits a session with most of the rows over several tasks and puts
    small ones into one, both by their bytes, so a partition gets as many files as it
    fills. Each file is sorted by key.
    """
    return df.hint("rebalance", *schemas.SERVING_PARTITIONS).sortWithinPartitions(*sort_keys(table))


def append(
    df: DataFrame, table: str, database: str | None = None, arrange: bool = True
) -> None:
    """Append rows to a serving table. Replayed rows are appended again.

    ``arrange=False`` skips the shuffle and only sorts within each task, which
    suits micro-batches that are already spread by key.
    """
    name = _name(table, database)
    rows = conform(df, table)
    rows = laid_out(rows, table) if arrange else rows.sortWithinPartitions(*sort_keys(table))
    rows.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def append_path(df: DataFrame, table: str, path: str, arrange: bool = True) -> None:
    """Append rows to a serving table that is a plain Parquet folder."""
    rows = conform(df, table)
    rows = laid_out(rows, table) if arrange else rows.sortWithinPartitions(*sort_keys(table))
    rows.write.mode("append").partitionBy(*schemas.SERVING_PARTITIONS).parquet(path)


def read_path(spark: SparkSession, table: str, path: str) -> DataFrame:
    return spark.read.schema(schemas.SERVING[table]).parquet(path).select(
        *schemas.SERVING[table].fieldNames()
    )


def batch_writer(
    table: str, database: str | None = None, path: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``. A retried batch appends again; versions settle it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if path:
            append_path(batch, table, path, arrange=False)
        else:
            append(batch, table, database, arrange=False)

    return write


def jdbc_writer(
    options: Mapping[str, str], table: str, batch_rows: int = 1000
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch`` that appends to a table of an outside store."""

    def write(batch: DataFrame, batch_id: int) -> None:
        conform(batch, table).write.format("jdbc").mode("append").options(
            **options, dbtable=table, batchsize=str(batch_rows)
        ).save()

    return write
