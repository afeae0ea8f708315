"""Averages on streams."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from rillflow.operators import averages as batch_averages
from rillflow.plans.shared import BatchTable, keys_as, same_keys, written
from rillflow.schemas import columns
from rillflow.streaming import opaque

SUMS = columns("count long, sum double")
SUMS_AND_LAST = columns("count long, sum double, last_micros long")

# Send the processors with the job, so executors need no installed copy of them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class RunningAverageProcessor(StatefulProcessor):
    """Keeps (count, sum) per key; one output row per input row, a chunk at a time."""

    def init(self, handle) -> None:
        self.sums = handle.getValueState("sums", SUMS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        count, total = self.sums.get() or (0, 0.0)
        for chunk in rows:
            counts = count + chunk["count_"].cumsum()
            sums = total + chunk["value_"].cumsum()
            count, total = int(counts.iloc[-1]), float(sums.iloc[-1])
            yield pd.DataFrame({
                "packed_": chunk["packed_"],
                "average_": (sums / counts).where(counts > 0),
                "counted_": counts,
            })
        self.sums.update((count, total))

    def close(self) -> None:
        pass


class InactivityProcessor(StatefulProcessor):
    """Keeps (count, sum, last time) per key; a timer gives the average out.

    A timer counts only if the key saw nothing newer since it was set. The sum is
    never reset. Rows of one batch come in no order, so the last time is the greatest.
    """

    def __init__(self, keys: Sequence[str], gap_millis: int):
        self.keys = list(keys)
        self.gap_millis = gap_millis

    def init(self, handle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", SUMS_AND_LAST)

    def _due(self, last_micros: int) -> int:
        return -(-last_micros // 1000) + self.gap_millis

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        count, total, before = self.sums.get() or (0, 0.0, None)
        last = before
        for chunk in rows:
            count += int(chunk["count_"].sum())
            total += float(chunk["value_"].sum())
            newest = int(chunk["micros_"].max())
            last = newest if last is None else max(last, newest)
        self.sums.update((count, total, last))
        if before is not None and self._due(before) != self._due(last):
            self.handle.deleteTimer(self._due(before))
        self.handle.registerTimer(self._due(last))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        count, total, last = self.sums.get()
        if count and expiredTimerInfo.getExpiryTimeInMs() >= self._due(last):
            row = {**dict(zip(self.keys, key)), "micros_": last, "average_": total / count}
            yield pd.DataFrame([row])

    def close(self) -> None:
        pass


def partial_sums_of(keys: Sequence[str]) -> Callable:
    """Sum the rows of each key in an Arrow batch, so that a hot key sends few rows on."""

    def sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by(keys).aggregate(
                [("micros_", "max"), ("value_", "sum"), ("count_", "sum")]
            )
            names = [*keys, "micros_", "value_", "count_"]
            ordered = sums.select([*keys, "micros__max", "value__sum", "count__sum"])
            yield from ordered.rename_columns(names).combine_chunks().to_batches()

    return sum_batches


# Names with a leading underscore would not survive the trip through pandas.
def _measured(value: str) -> dict:
    """The value as a number to sum, and whether it counts."""
    return {
        "value_": F.coalesce(F.col(value).cast("double"), F.lit(0.0)),
        "count_": F.col(value).isNotNull().cast("long"),
    }


def _group_columns(keys: Sequence[str]) -> list:
    return [F.col(key).alias(name) for key, name in zip(keys, _group_names(keys))]


def _group_names(keys: Sequence[str]) -> list[str]:
    return [f"k{n}_" for n in range(len(keys))]


def running_average_stream(
    df: DataFrame, keys: Sequence[str], value: str, out: str = "average", counted: str | None = None
) -> DataFrame:
    """Average of a key's values so far, one output row per input row.

    ``counted`` names an optional column with the number of values in the average. Every row of a key passes through that key's state, one chunk after the other.
    :func:`running_average_batches` gives the same rows with hot keys spread, and
    :func:`average_updates` one average per key and batch.
    """
    averaged = (
        df.withColumns({"packed_": opaque.pack(df.columns), **_measured(value)})
        .select(*_group_columns(keys), "packed_", "value_", "count_")
        .groupBy(*_group_names(keys))
        .transformWithStateInPandas(
            statefulProcessor=RunningAverageProcessor(),
            outputStructType=columns("packed_ string, average_ double, counted_ long"),
            outputMode="Append",
            timeMode="None",
        )
    )
    row = opaque.unpack(F.col("packed_"), df.schema).alias("_row")
    added = {out: "average_", **({counted: "counted_"} if counted else {})}
    named = averaged.select(row, *[F.col(found).alias(name) for name, found in added.items()])
    return named.select("_row.*", *added)


def running_average_batches(
    keys: Sequence[str],
    value: str,
    order: str,
    sums_path: str,
    sink: Callable[[DataFrame, int], None],
    out: str = "average",
    block_rows: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: the batch operator on each micro-batch.

    The (count, sum) of every key is kept below ``sums_path`` as a :class:`BatchTable`, to which
    a batch adds only the keys it has rows of. A batch that runs again finds the sums of the
    one before it and overwrites its own, so a retry gives the same rows. A restart with other
    keys fails at its first batch.
    """
    checked: list[bool] = []

    def average(batch: DataFrame, batch_id: int) -> None:
        schema = T.StructType([*[batch.schema[key] for key in keys], *SUMS.fields])
        table = BatchTable(batch.sparkSession, sums_path, schema, tuple(keys))
        if not checked:
            table.check()
            checked.append(True)
        before = table.before(batch_id) if batch_id > 0 else None
        sink(
            batch_averages.running_average(
                batch, keys, value, order, out, block_rows, opening=before
            ),
            batch_id,
        )
        table.write(batch_id, _added(
            before, batch_averages.partial_sums(
                batch.withColumn(value, F.col(value).cast("double")), keys, value
            ), keys,
        ))

    return average


def _added(before: DataFrame | None, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The (count, sum) of the keys in ``new``, with what they had before."""
    new = new.withColumn("new_", F.lit(True))
    if before is not None:
        new = new.unionByName(before.withColumn("new_", F.lit(False)))
    return new.groupBy(*keys).agg(
        F.sum("count").alias("count"), F.sum("sum").alias("sum"), F.max("new_").alias("new_")
    ).filter("new_").drop("new_")


def inactivity_average_batches(
    keys: Sequence[str],
    value: str,
    event_time: str,
    state_path: str,
    sink: Callable[[DataFrame, int], None],
    gap_seconds: float = 5.0,
    lateness_seconds: float = 0.0,
    out: str = "average",
    block_rows: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: the average so far after every silence of every key.

    A silence is given out in the first batch whose watermark, the newest event time so far less
    ``lateness_seconds``, lies beyond its end; rows before the watermark of the batch before are
    late and left out, and so are rows without a time. So the rows given out don't hang on how
    the stream is cut. Below ``state_path`` each batch keeps the (count, sum) of the keys it
    settled, all moments whose gap is still open, and the watermark. What is open reaches back
    ``gap_seconds`` and the lateness from the newest time, whatever the length of the stream.

    A batch that runs again overwrites its own state and gives the same rows; a restart with
    other keys fails at its first batch. A hot key is cut into blocks as in the batch operator.
    """
    checked: list[bool] = []
    gap, lateness = int(gap_seconds * 1_000_000), int(lateness_seconds * 1_000_000)
    micros = F.unix_micros(event_time)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        key_fields = [batch.schema[key] for key in keys]
        moment = T.StructType([
            *key_fields, batch.schema[event_time], *columns("_sum double, _count long").fields
        ])
        sums = BatchTable(
            spark, f"{state_path}/sums", T.StructType([*key_fields, *SUMS.fields]), tuple(keys)
        )
        if not checked:
            sums.check()
            checked.append(True)
        open_moments = BatchTable(spark, f"{state_path}/open", moment, full_every=1)
        marks = BatchTable(spark, f"{state_path}/watermark", columns("micros long"), full_every=1)
        known = marks.before(batch_id).first()
        known = known["micros"] if known else None
        new = batch_averages.moments_of(batch, keys, value, event_time)
        if known is not None:
            new = new.filter(micros >= F.lit(known))
        moments = written(
            new.unionByName(open_moments.before(batch_id)).groupBy(*keys, event_time).agg(
                F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count")
            ), "moments", f"{state_path}/moments/{batch_id % 2}",
        )
        newest = moments.agg(F.max(micros)).first()[0]
        if newest is not None:
            newest -= lateness
        mark = max((at for at in (known, newest) if at is not None), default=None)
        settled = F.lit(False) if mark is None else micros + gap < F.lit(mark)
        touched = keys_as(moments, keys, "own_").distinct()
        before = sums.before(batch_id).join(touched, same_keys(keys, "own_"), "left_semi")
        if mark is not None:
            sink(batch_averages.silences(
                moments, keys, event_time, gap_seconds, out, block_rows, opening=before, until=mark
            ), batch_id)
        sums.write(batch_id, _added(before, moments.filter(settled).groupBy(*keys).agg(
            F.sum("_count").alias("count"), F.sum("_sum").alias("sum")
        ), keys))
        open_moments.write(batch_id, moments.filter(~settled))
        marks.write(batch_id, spark.range(1).select(F.lit(mark).cast("long").alias("micros")))

    return step


def average_updates(
    df: DataFrame, keys: Sequence[str], value: str, out: str = "average"
) -> DataFrame:
    """Average so far of every key a batch touches; for update or complete mode.

    Each task sums its own rows before the shuffle, so a hot key costs one row per task.
    """
    return df.groupBy(*keys).agg(F.avg(value).alias(out))


def inactivity_average_stream(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    event_time: str,
    gap_seconds: float = 5.0,
    lateness: str = "0 seconds",
    out: str = "average",
) -> DataFrame:
    """Average so far of every key that stays silent for the gap, by event time.

    Rows are summed per key before the shuffle, so a hot key sends one row per Arrow
    batch to its state, and of the silences inside a micro-batch only a key's last counts;
    :func:`inactivity_average_batches` gives out every one. Timers follow the watermark. A
    bounded run therefore ends before the timers of the newest records are due.
    """
    names = _group_names(keys)
    key_fields = [T.StructField(name, df.schema[key].dataType) for name, key in zip(names, keys)]
    parts = T.StructType(
        [*key_fields, *columns("micros_ long, value_ double, count_ long").fields]
    )
    emitted = (
        df.filter(F.col(event_time).isNotNull())
        .withColumns({"micros_": F.unix_micros(event_time), **_measured(value)})
        .select(*_group_columns(keys), "micros_", "value_", "count_")
        .mapInArrow(partial_sums_of(names), parts)
        .withColumn("time_", F.timestamp_micros("micros_"))
        .withWatermark("time_", lateness)
        .groupBy(*names)
        .transformWithStateInPandas(
            statefulProcessor=InactivityProcessor(names, int(gap_seconds * 1000)),
            outputStructType=T.StructType(
                [*key_fields, *columns("micros_ long, average_ double").fields]
            ),
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    return emitted.select(
        *[F.col(name).alias(key) for name, key in zip(names, keys)],
        F.timestamp_micros("micros_").alias(event_time),
        F.col("average_").alias(out),
    )
