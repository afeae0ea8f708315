"""Closed partitions of a serving table, kept as their newest versions.

A serving table only grows, and every read picks the newest version of each key anew. Here
the partitions that a caller calls closed are merged once into a second folder, sorted by
key, and a list says which files of the table went into it. A read takes merged partitions
as they are, without a shuffle, and picks versions only among the files that came later and
the merged rows of the partitions they belong to. So late rows for a closed partition count
as well, and its next merge takes them in.

Merged rows of one run lie below a generation of their own and count once their list is
written. A run that stops before that leaves rows nobody reads; the next run overwrites them.
Readers that began before go on reading the older generation.

The driver holds names of files and partitions, as Spark's own index of a folder does, and
no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from rillflow import schemas
from rillflow.operators import versions
from rillflow.sinks import serving

LIST = "generation long, folder string, file string"
EMPTY_PARTITION = "__HIVE_DEFAULT_PARTITION__"
DEPTH = len(schemas.SERVING_PARTITIONS)


def _folder(file: str) -> str:
    """The partition part of a file's path."""
    return "/".join(file.split("/")[-1 - DEPTH:-1])


def _short(file: str) -> str:
    """Partition and name of a file: what stays the same when a table is reached by another path."""
    return "/".join(file.split("/")[-1 - DEPTH:])


def partition_values(folder: str) -> dict[str, int | None]:
    """``a=1/b=2`` as a dictionary."""
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return {name: None if value == EMPTY_PARTITION else int(value) for name, value in pairs}


@dataclass
class Merged:
    """The newest generation of each merged partition, and the files that were merged."""

    newest: dict[str, int]
    files: set[str]


def merged(spark: SparkSession, settled_path: str) -> Merged:
    try:
        listed = spark.read.schema(LIST).parquet(f"{settled_path}/files").toArrow().to_pylist()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = []
    newest: dict[str, int] = {}
    for row in listed:
        newest[row["folder"]] = max(row["generation"], newest.get(row["folder"], 0))
    return Merged(newest, {row["file"] for row in listed})


def _later_files(spark: SparkSession, table: str, path: str, state: Merged) -> list[str]:
    files = map(unquote, spark.read.schema(schemas.SERVING[table]).parquet(path).inputFiles())
    return sorted(file for file in files if _short(file) not in state.files)


def _rows(spark: SparkSession, table: str, root: str, paths: list[str]) -> DataFrame:
    schema = schemas.SERVING[table]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*schema.fieldNames())


def _merged_rows(
    spark: SparkSession, table: str, settled_path: str, state: Merged, folders: set[str]
) -> DataFrame:
    root = f"{settled_path}/rows"
    paths = [f"{root}/generation={state.newest[f]}/{f}" for f in sorted(folders & state.newest.keys())]
    return _rows(spark, table, root, paths)


def settle(
    spark: SparkSession, table: str, path: str, settled_path: str,
    closed: Callable[[Mapping[str, int | None]], bool],
) -> int:
    """Merge what came since the last run into the closed partitions; returns how many changed.

    ``closed`` is asked with the values of each partition that has later files. Run one
    ``settle`` of a table at a time.
    """
    state = merged(spark, settled_path)
    later = [
        file for file in _later_files(spark, table, path, state)
        if closed(partition_values(_folder(file)))
    ]
    if not later:
        return 0
    folders = {_folder(file) for file in later}
    generation = max(state.newest.values(), default=0) + 1
    rows = _merged_rows(spark, table, settled_path, state, folders).unionByName(
        _rows(spark, table, path, later)
    )
    newest = serving.in_key_ranges(versions.consistent_read(rows), table)
    newest.write.mode("overwrite").partitionBy(*schemas.SERVING_PARTITIONS).parquet(
        f"{settled_path}/rows/generation={generation}"
    )
    names = [(generation, _folder(file), _short(file)) for file in later]
    spark.createDataFrame(names, LIST).coalesce(1).write.mode("append").parquet(f"{settled_path}/files")
    return len(folders)


def consistent_read_incremental(
    spark: SparkSession, table: str, path: str, settled_path: str
) -> DataFrame:
    """The rows of ``versions.consistent_read`` of the table, with merged partitions as they are."""
    state = merged(spark, settled_path)
    later = _later_files(spark, table, path, state)
    touched = {_folder(file) for file in later}
    untouched = _merged_rows(spark, table, settled_path, state, state.newest.keys() - touched)
    if not later:
        return untouched
    again = _merged_rows(spark, table, settled_path, state, touched).unionByName(
        _rows(spark, table, path, later)
    )
    return untouched.unionByName(versions.consistent_read(again))
