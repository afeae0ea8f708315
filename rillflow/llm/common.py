"""Helpers the operators share: held tables, row keys, Arrow slices, word hashes, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.session import scratch_path

#: Bytes that part words: the space and 0x09 to 0x0D. All are ASCII, so bytes can be tested.
SEPARATORS = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes that one slice of an Arrow batch holds at most (one row may be longer).
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch between Spark and Python, unless one row is longer.
BATCH_BYTES = 8 << 20


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage, so later steps neither recompute it nor depend on the executors
    that made it. Spark knows the size of the files, so its own size check decides whether
    a join broadcasts such a table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def batched(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of its session bounded by bytes and not by rows alone.

    Ten thousand long texts, Spark's bound by rows, would be gigabytes.
    """
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key) != str(BATCH_BYTES):
        conf.set(key, str(BATCH_BYTES))
    return df


def tidy() -> None:
    """Give back what earlier tasks of a reused Python worker have freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def as_row(df: DataFrame, *dropped: str) -> DataFrame:
    """All columns of ``df`` but ``dropped`` in one struct ``row_``.

    Joins that add columns can then not clash with columns that only pass through.
    """
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns if c not in dropped]).alias("row_"))


def row_columns(df: DataFrame) -> list[Column]:
    """The columns packed by ``as_row``."""
    return [F.col("row_").getField(name).alias(name) for name in df.schema["row_"].dataType.names]


def crc_remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def text_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches of a task as ``cut`` parts them; memory is given back before and after."""
    tidy()
    yield from cut(batches, text, most)
    tidy()


def cut(batches: Iterator[pa.RecordBatch], text: str = "text",
        most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a slice holds at most ``most`` text bytes or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_parts(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(at, at[start] + most, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers, so that all bits depend on all bits."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _byte_codes() -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)


_CODES = _byte_codes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[32, 9, 10, 11, 12, 13]] = True
_ODD = 0xD6E8FEB86659FD93
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """The first n powers of an odd number modulo 2^64, kept for the next call."""
    kept = _powers.get(base)
    if kept is None or len(kept) < n:
        kept = np.full(max(n, 1 << 16), base, np.uint64)
        kept[0] = 1
        with np.errstate(over="ignore"):
            kept = np.cumprod(kept, dtype=np.uint64)
        if len(kept) <= 4 << 20:
            _powers[base] = kept
    return kept[:n]


def word_hashes(data: np.ndarray, at: np.ndarray, lower: bool = True
                ) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a slice of texts, and the number of words of each text.

    Words part at ``SEPARATORS`` and at the ends of texts; ``lower`` folds A-Z. A word's
    hash is a scrambled polynomial of its bytes, taken from running sums over the slice.
    """
    texts = len(at) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(texts, np.int64)
    if texts == 1 and len(data) > 2 * SLICE_BYTES:
        # One very long text: in pieces that end at gaps, so that memory stays bounded.
        gaps = np.flatnonzero(_IS_GAP[data])
        wanted = np.arange(SLICE_BYTES, len(data), SLICE_BYTES)
        cuts = gaps[np.minimum(np.searchsorted(gaps, wanted), len(gaps) - 1)] if len(gaps) else []
        bounds = np.unique(np.r_[0, cuts, len(data)]).astype(np.int64)
        if len(bounds) > 2:
            found = np.concatenate([
                word_hashes(data[a:b], np.array([0, b - a]), lower)[0]
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
            ])
            return found, np.array([len(found)], np.int64)
    if lower:
        data = _LOWER[data]
    solid = np.empty(len(data) + 2, bool)
    solid[0] = solid[-1] = False
    np.logical_not(_IS_GAP[data], out=solid[1:-1])
    before = solid[:-1] & ~solid[1:]
    after = ~solid[:-1] & solid[1:]
    # A text that ends in a word right before the next text's first word parts there too.
    edges = at[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    edges = edges[solid[edges] & solid[edges + 1]]
    before[edges] = True
    after[edges] = True
    starts, ends = np.flatnonzero(after), np.flatnonzero(before)
    with np.errstate(over="ignore"):
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_CODES[data] * _power(_ODD, len(data)), out=sums[1:])
        words = (sums[ends] - sums[starts]) * _power(_ODD_INVERSE, len(data))[starts]
        words ^= (ends - starts).astype(np.uint64) * _STEP
    bounds = np.searchsorted(starts, at)
    return mixed(words), np.diff(bounds)


def chained(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of parallel hash arrays; the order of the parts counts."""
    total = np.zeros(len(parts[0]), np.uint64)
    with np.errstate(over="ignore"):
        for part in parts:
            total = mixed(total * np.uint64(_ODD) + part + _STEP)
    return total


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """The smallest reachable id for every id in ``edges`` (columns a, b): (id, component).

    Each round hooks every label to the smallest label next to it and then jumps pointers,
    so long chains need a logarithmic number of rounds. An edge inside one component is
    dropped as soon as that is known, and equal edges fall together. Labels and edges are
    cut from their lineage every round. Edges of null ids must not be given.
    """
    spark = edges.sparkSession
    pairs = held(
        edges.filter("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        ).distinct(),
        "edges",
    )
    labels = held(
        pairs.select("a", "b").groupBy(F.col("b").alias("id")).agg(F.min("a").alias("component"))
        .unionByName(pairs.select(F.col("a").alias("id"), F.col("a").alias("component")))
        .groupBy("id").agg(F.min("component").alias("component")),
        "labels",
    )
    for _ in range(rounds):
        # Pointer jumping: a label is itself an id, whose label is at least as small.
        up = labels.select(F.col("id").alias("up_id"), F.col("component").alias("up"))
        labels = held(
            labels.join(up, F.col("component") == F.col("up_id"), "left")
            .select("id", F.coalesce("up", "component").alias("component")),
            "labels",
        )
        a = labels.select(F.col("id").alias("a"), F.col("component").alias("la"))
        b = labels.select(F.col("id").alias("b"), F.col("component").alias("lb"))
        open_pairs = held(
            pairs.join(a, "a").join(b, "b").filter("la <> lb")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
            .distinct(),
            "edges",
        )
        flat = (
            labels.join(up, F.col("component") == F.col("up_id"))
            .filter("component <> up").isEmpty()
        )
        if open_pairs.isEmpty() and flat:
            return labels
        pairs = open_pairs
        hooks = pairs.groupBy(F.col("b").alias("hook_id")).agg(F.min("a").alias("hook"))
        labels = held(
            labels.join(hooks, F.col("id") == F.col("hook_id"), "left")
            .select("id", F.least("component", F.coalesce("hook", "component")).alias("component")),
            "labels",
        )
    raise RuntimeError("the components did not settle; raise rounds")
