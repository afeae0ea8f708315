"""The streaming reference join on built-in joins: what it remembers are tables, not state stores.

Per micro-batch it keeps the newest record of every key and the rows that wait for their first
one, as :class:`BatchTable` folders. Rows stay columns all the way: nothing is packed, and no
Python sees them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.operators.lookup import HOT_ROWS, lookup_join
from rillflow.plans.shared import BatchTable, written
from rillflow.plans.sizing import BROADCAST_ROWS
from rillflow.schemas import DRIVER_COLUMNS, DRIVER_KEYS


@dataclass(frozen=True)
class ReferenceJoin:
    """A join of streamed telemetry to streamed reference records.

    A record of an earlier micro-batch serves all telemetry of a batch, and the batch's own
    last record, by the time ``arrival``, if given (null first), and then by ``version``, takes
    over after it. Where none is known, telemetry is held; the first record of a later
    batch, or of its own, releases it, once. Rows whose key has a null are left out.

    ``state_path`` belongs to one checkpoint. A batch that runs again reads the state that the
    one before it left and overwrites its own, so it gives the same rows. A restart with other
    keys, columns or ``full_every`` fails at its first batch. Telemetry is joined to
    the known records by broadcast where they are proven small; else hot keys of the batch are
    spread over ``salts`` tasks. With ``ttl_seconds``, held rows are dropped after that time.
    """

    telemetry: DataFrame
    reference: DataFrame
    state_path: str
    keys: Sequence[str] = tuple(DRIVER_KEYS)
    record_columns: Sequence[str] = tuple(DRIVER_COLUMNS)
    version: str = "version"
    arrival: str | None = None
    ttl_seconds: float | None = None
    salts: int = 16
    hot_rows: int = HOT_ROWS
    broadcast_rows: int = BROADCAST_ROWS
    full_every: int = 16

    @property
    def _row(self) -> T.StructType:
        return T.StructType([self.telemetry.schema[name] for name in self.telemetry.columns])

    @property
    def _record(self) -> T.StructType:
        return T.StructType([self.reference.schema[name] for name in self.record_columns])

    @property
    def _key(self) -> T.StructType:
        return T.StructType([T.StructField(key, T.LongType()) for key in self.keys])

    def inputs(self) -> DataFrame:
        """Both streams as one: what ``foreachBatch`` gets."""
        key = F.struct(*[F.col(key).cast("long").alias(key) for key in self.keys]).alias("_key")
        since = F.unix_micros(self.arrival) if self.arrival else F.lit(None)
        rows = self.telemetry.dropna(subset=list(self.keys)).select(
            key, F.struct(*self.telemetry.columns).alias("_telemetry"),
            F.lit(None).cast(self._record).alias("_record"),
            F.lit(None).cast("long").alias("_since"), F.lit(None).cast("long").alias("_tie"),
        )
        records = self.reference.dropna(subset=list(self.keys)).select(
            key, F.lit(None).cast(self._row).alias("_telemetry"),
            F.struct(*self.record_columns).alias("_record"),
            since.cast("long").alias("_since"), F.col(self.version).cast("long").alias("_tie"),
        )
        return rows.unionByName(records)

    def known(self, spark: SparkSession) -> BatchTable:
        """The newest record of every key."""
        schema = T.StructType([T.StructField("_key", self._key), T.StructField("_record", self._record)])
        return BatchTable(spark, f"{self.state_path}/known", schema, ("_key",), self.full_every)

    def held(self, spark: SparkSession) -> BatchTable:
        """Rows that had to wait; those whose key is known by now have gone out."""
        schema = T.StructType([
            T.StructField("_key", self._key), T.StructField("_telemetry", self._row),
            T.StructField("_held", T.TimestampType()),
        ])
        return BatchTable(spark, f"{self.state_path}/held", schema, (), self.full_every)

    def waiting(self, spark: SparkSession, batches: int) -> DataFrame:
        """Telemetry that waits after so many batches."""
        known = self.known(spark).before(batches).select("_key")
        rows = self._alive(self.held(spark).before(batches)).join(known, "_key", "left_anti")
        return rows.select("_telemetry.*")

    def _alive(self, held: DataFrame) -> DataFrame:
        if self.ttl_seconds is None:
            return held
        oldest = F.current_timestamp() - F.make_dt_interval(secs=F.lit(self.ttl_seconds))
        return held.filter(F.col("_held") >= oldest)

    def step(self, sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """Function for ``foreachBatch``; ``sink`` gets the joined rows of every batch."""

        checked: list[bool] = []

        def join(batch: DataFrame, batch_id: int) -> None:
            spark, slot = batch.sparkSession, batch_id % 2
            known, held = self.known(spark), self.held(spark)
            if not checked:
                known.check()
                held.check()
                checked.append(True)
            # Several steps read it, and every read of the batch itself would decode its rows again.
            batch = written(batch, "batch", f"{self.state_path}/batch/{slot}")
            order = F.struct("_since", "_tie", "_record")
            # Every task brings a key's records down to two before the shuffle.
            arrived = written(batch.filter(F.col("_record").isNotNull()).groupBy("_key").agg(
                F.min_by("_record", order).alias("first"), F.max_by("_record", order).alias("last")
            ), "arrived", f"{self.state_path}/arrived/{slot}")
            before = known.before(batch_id)
            new = written(
                arrived.join(before.select("_key"), "_key", "left_anti")
                .select("_key", F.col("first").alias("_record")),
                "new", f"{self.state_path}/new/{slot}",
            )
            serving = before.unionByName(new).withColumnRenamed("_key", "_id")
            telemetry = batch.filter(F.col("_telemetry").isNotNull()).select("_key", "_telemetry")
            # Written once: the sink, and what is held, read it without joining again.
            joined = written(lookup_join(
                telemetry, serving, "_key", "_id", self.salts, self.hot_rows, self.broadcast_rows
            ).select("_key", "_telemetry", "_record"), "joined", f"{self.state_path}/joined/{slot}")
            waited = self._alive(held.before(batch_id))
            released = waited.join(new, "_key").select("_key", "_telemetry", "_record")
            out = joined.filter(F.col("_record").isNotNull()).unionByName(released)
            sink(out.select("_telemetry.*", "_record.*"), batch_id)
            unknown = joined.filter(F.col("_record").isNull()).select(
                "_key", "_telemetry", F.current_timestamp().alias("_held")
            )
            if held.is_full(batch_id):
                still = waited.join(serving.select(F.col("_id").alias("_key")), "_key", "left_anti")
                unknown = unknown.unionByName(still)
            held.write(batch_id, unknown)
            known.write(batch_id, arrived.select("_key", F.col("last").alias("_record")))

        return join
