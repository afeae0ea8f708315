"""Streaming join of telemetry to reference records, holding early rows."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from rillflow.schemas import DRIVER_COLUMNS, DRIVER_KEYS, columns
from rillflow.streaming import opaque

# Rows held in memory before they go to the state store.
HELD_ROWS = 20_000

RECORD = columns("since long, record string")
PENDING = columns("telemetry string")
# Names with a leading underscore would not survive the trip through pandas.
PAIR = columns("telemetry_ string, record_ string")

# Send the processor with the job, so executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class ReferenceProcessor(StatefulProcessor):
    """Keeps the newest reference record per key, and the rows that wait for the first.

    Within one batch a key's rows come in no order, and topics have none between them.
    So a known record serves all telemetry of the batch, and the batch's own records
    take over after it: a record of a later batch always replaces the known one, whatever
    its version. Where none is known, telemetry is held; the first record of the batch, by
    arrival, releases it. Memory stays bounded either way.
    """

    def __init__(self, ttl_millis: int | None = None):
        self.ttl_millis = ttl_millis

    def init(self, handle) -> None:
        self.record = handle.getValueState("record", RECORD)
        self.pending = handle.getListState("pending", PENDING, self.ttl_millis)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.record.get()
        first = last = None
        held: list[str] = []
        for chunk in rows:
            is_record = chunk["record_"].notna()
            telemetry = chunk["telemetry_"][~is_record].tolist()
            arrived = chunk[is_record]
            for found in zip(arrived["since_"], arrived["tie_"], arrived["record_"]):
                first = found if first is None else min(first, found)
                last = found if last is None else max(last, found)
            if not telemetry:
                continue
            if known is not None:
                yield self._pairs(telemetry, known[1])
                continue
            held += telemetry
            if len(held) >= HELD_ROWS:
                self.pending.appendList([(row,) for row in held])
                held = []
        if known is None and first is None:
            if held:
                self.pending.appendList([(row,) for row in held])
            return
        if known is None:
            if held:
                yield self._pairs(held, first[2])
            if self.pending.exists():
                waiting = (row[0] for row in self.pending.get())
                while released := list(islice(waiting, HELD_ROWS)):
                    yield self._pairs(released, first[2])
                self.pending.clear()
        if last is not None:
            self.record.update((int(last[0]), last[2]))

    @staticmethod
    def _pairs(telemetry: list[str], record: str) -> pd.DataFrame:
        return pd.DataFrame({"telemetry_": telemetry, "record_": record})

    def close(self) -> None:
        pass


def reference_join_stream(
    telemetry: DataFrame,
    reference: DataFrame,
    keys: Sequence[str] = DRIVER_KEYS,
    record_columns: Sequence[str] = DRIVER_COLUMNS,
    version: str = "version",
    salts: int = 1,
    ttl_millis: int | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """Streaming form of the reference join; both inputs are streams.

    Records of a later micro-batch replace those of an earlier one. Within a batch they
    are ordered by the time ``arrival``, if given (null first), and then by ``version``.
    ``salts`` spreads a key's
    telemetry over that many states by a hash of its columns, each with its own copy of
    the key's reference records, so that a hot key does not sit in one task. A query must keep
    its salts: give ``layout={"salts": salts}`` to what starts it. Held rows
    stay until their record comes, unless ``ttl_millis`` is given. With a time to live,
    Spark keeps on looking for expired rows, so a bounded trigger would not end.
    """
    same_keys = [F.col(key).cast("long").alias(f"k{n}_") for n, key in enumerate(keys)]
    groups = [f"k{n}_" for n in range(len(keys))]
    nothing = F.lit(None).cast("string")
    left = telemetry.select(
        *same_keys,
        F.pmod(F.xxhash64(*telemetry.columns), F.lit(salts)).cast("int").alias("salt_"),
        opaque.pack(telemetry.columns).alias("telemetry_"),
        F.lit(0).cast("long").alias("since_"),
        F.lit(0).cast("long").alias("tie_"),
        nothing.alias("record_"),
    )
    right = reference.select(
        *same_keys,
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt_"),
        nothing.alias("telemetry_"),
        (F.coalesce(F.unix_micros(arrival), F.lit(-(2**62))) if arrival else F.lit(0))
        .cast("long").alias("since_"),
        F.col(version).cast("long").alias("tie_"),
        opaque.pack(record_columns).alias("record_"),
    )
    pairs = (
        left.unionByName(right)
        .dropna(subset=groups)
        .groupBy(*groups, "salt_")
        .transformWithStateInPandas(
            statefulProcessor=ReferenceProcessor(ttl_millis),
            outputStructType=PAIR,
            outputMode="Append",
            timeMode="ProcessingTime" if ttl_millis else "None",
        )
    )
    payload = T.StructType([telemetry.schema[name] for name in telemetry.columns])
    record = T.StructType([reference.schema[name] for name in record_columns])
    return pairs.select(
        opaque.unpack(F.col("telemetry_"), payload).alias("_t"),
        opaque.unpack(F.col("record_"), record).alias("_r"),
    ).select("_t.*", "_r.*")


def waiting_state(
    spark: SparkSession, checkpoint: str, telemetry: T.StructType
) -> DataFrame:
    """Telemetry now held by a query, read from its checkpoint's state store."""
    held = (
        spark.read.format("statestore").option("stateVarName", "pending").load(checkpoint)
    )
    row = opaque.unpack(F.col("list_element.telemetry"), telemetry)
    return held.select(row.alias("_row")).select("_row.*")
