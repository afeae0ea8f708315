"""Tables in the shared folder, which cut lineage and survive lost executors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.session import scratch_path


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder, or over ``path``, and read again.

    Later steps neither recompute it nor depend on the executors that made it, and Spark
    knows its size when it picks a join.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same_layout(spark: SparkSession, path: str, layout: Mapping[str, object]) -> None:
    """Record how a stream lays out what it remembers, or fail if a start before did otherwise.

    State is found again only by the layout it was written with: other salts look for a key in
    other states, other keys or folders of whole tables read the wrong rows. Without a word
    the stream would go on as if it had seen nothing.
    """
    now = {name: str(value) for name, value in layout.items()}
    try:
        rows = spark.read.schema("name string, value string").parquet(path).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    before = {row["name"]: row["value"] for row in rows}
    if not before:
        pairs = spark.createDataFrame(list(now.items()), "name string, value string")
        pairs.coalesce(1).write.mode("overwrite").parquet(path)
    elif before != now:
        other = sorted(name for name in before.keys() | now.keys() if before.get(name) != now.get(name))
        changes = "; ".join(f"{name} was {before.get(name)}, is {now.get(name)}" for name in other)
        raise ValueError(f"the state recorded at {path} has another layout: {changes}")


@dataclass(frozen=True)
class BatchTable:
    """A keyed table that micro-batches change, one Parquet folder per batch.

    A batch writes the rows it changed; every ``full_every``-th writes the whole table, so a
    reader opens at most that many folders and takes the newest row of each key. A batch that
    runs again reads what the one before it left and overwrites its own folder. Without ``keys``
    all rows of the folders are the table's, and the whole table is given with the full batches.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    full_every: int = 16

    def folder(self, batch_id: int) -> str:
        return f"{self.path}/b{batch_id:09d}"

    def is_full(self, batch_id: int) -> bool:
        return batch_id % self.full_every == 0

    def check(self) -> None:
        """Fail if the folders were written by a table of another layout."""
        same_layout(self.spark, f"{self.path}/layout", {
            "schema": self.schema.simpleString(), "keys": ",".join(self.keys), "full_every": self.full_every,
        })

    def before(self, batch_id: int) -> DataFrame:
        """The table as it was before the batch; empty before the first."""
        if batch_id <= 0:
            return self.spark.range(0).select(
                *[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
            )
        full = (batch_id - 1) // self.full_every * self.full_every
        folders = [self.folder(n) for n in range(full, batch_id)]
        stored = T.StructType([*self.schema.fields, T.StructField("_batch", T.LongType())])
        rows = self.spark.read.schema(stored).parquet(*folders)
        if not self.keys or len(folders) == 1:
            return rows.drop("_batch")
        others = [f.name for f in self.schema.fields if f.name not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*others), "_batch").alias("_row"))
        return newest.select(*self.keys, "_row.*").select(*self.schema.fieldNames())

    def write(self, batch_id: int, changed: DataFrame) -> None:
        """Keep the rows a batch changed, whole rows by their keys."""
        names = self.schema.fieldNames()
        rows = changed.select(*names)
        if self.keys and batch_id > 0 and self.is_full(batch_id):
            old = self.before(batch_id).withColumn("_batch", F.lit(0))
            both = old.unionByName(rows.withColumn("_batch", F.lit(1)))
            others = [name for name in names if name not in self.keys]
            rows = both.groupBy(*self.keys).agg(
                F.max_by(F.struct(*others), "_batch").alias("_row")
            ).select(*self.keys, "_row.*")
        rows.select(*names, F.lit(batch_id).cast("long").alias("_batch")) \
            .write.mode("overwrite").parquet(self.folder(batch_id))


def same_keys(keys: Sequence[str], prefix: str) -> list:
    """Conditions that join ``keys`` to their namesakes behind ``prefix``; null equals null."""
    return [F.col(key).eqNullSafe(F.col(f"{prefix}{key}")) for key in keys]


def keys_as(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Only the keys of ``df``, under names with ``prefix``."""
    return df.select(*[F.col(key).alias(f"{prefix}{key}") for key in keys])
