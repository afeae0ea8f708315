"""Tries of conversations: every distinct sequence of first turns is a node.

A prefix is known by 128 bits: the exclusive or of its turns' hashes, each taken together with
its depth. So prefixes are running aggregates, and a conversation of any length is worked on in
chunks of turns that need only one number of each other.

Most prefixes belong to one conversation. A count-min sketch of all prefixes tells which: its
estimate is never too small, so one means one. If a prefix is a singleton, all longer prefixes of
its conversation are, and these tails are given out where they are read. Only prefixes that may
be shared are shuffled and grouped exactly. The sketch has a bounded number of cells, which grow
with the rows up to it; with more rows more singletons pass as possibly shared and the exact
grouping finds them.

No step walks the trie. A node is represented by its smallest conversation, which then also
represents all of its own longer prefixes that no smaller one shares. So sums over a subtree are
sums over its members of what they represent from that depth on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.common import held

#: Turns of one conversation that a window takes at a time.
CHUNK_TURNS = 4096
#: Cells in each of the four rows of the sketch: four for every prefix, and at most so many.
MOST_CELLS = 1 << 24
_LEAST_CELLS = 1 << 12
_SLICE = 1 << 16
#: Ids in one piece of text before it is hashed.
PIECE_IDS = 8192

_PREFIX = ["depth", "lx", "ly"]
_NO_IDS = hashlib.sha256(b"").hexdigest()


def ranked(rows: DataFrame, key: str, order: Sequence[Column], out: str = "place_") -> DataFrame:
    """``rows`` with their place among the rows of their key, from 1 on.

    Rows are dealt by ranges of (key, order), so a key of any size is ranked by many tasks; what
    a task needs from those before it is one number for the key it begins with.
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = held(
        rows.repartitionByRange(tasks, F.col(key), *order).withColumn("task_", F.spark_partition_id()),
        "dealt",
    )
    before = W.partitionBy(key).orderBy("task_").rowsBetween(W.unboundedPreceding, -1)
    # At most one key of every task began in an earlier one.
    open_keys = dealt.groupBy(key, "task_").agg(F.count("*").alias("n_")).select(
        key, "task_", F.sum("n_").over(before).alias("before_")
    ).filter(F.col("before_").isNotNull())
    inside = F.row_number().over(W.partitionBy(key, "task_").orderBy(*order))
    return dealt.withColumn("at_", inside).join(F.broadcast(open_keys), [key, "task_"], "left").withColumn(
        out, F.col("at_") + F.coalesce("before_", F.lit(0))
    ).drop("task_", "at_", "before_")


def turn_marks(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Turns as (id_, turn_, m1, m2, chars): two hashes of role and text, and the text's code points.

    Null role or text is empty. Turns without a conversation are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    return turns.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id_"), F.col(turn_col).alias("turn_"),
        F.xxhash64(role, text).alias("m1"), F.xxhash64(F.lit(11), text, role).alias("m2"),
        F.char_length(text).cast("long").alias("chars"),
    )


def with_lent_heads(marks: DataFrame, group: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of their group's first one: (ids, turns).

    A conversation c gives up its first h turns, h = crc32(c as text) modulo ``most`` + 1, and gets
    the first h of conversation c - c % group instead (all if it has fewer, none if it is absent).
    Turns are (id_, depth, m1, m2, chars), depth from 1 on; ids may have none. Order within a
    conversation: turn, null first; turns of one number by their hashes.
    """
    places = held(
        ranked(marks, "id_", [F.asc_nulls_first("turn_"), F.asc("m1"), F.asc("m2")]).drop("turn_"), "places"
    )
    ids = places.filter("place_ = 1").select("id_")
    lender = F.col("id_") - F.col("id_") % group
    wanted = F.crc32(F.col("id_").cast("string")) % (most + 1)
    heads = held(
        places.filter((F.col("id_") % group == 0) & (F.col("place_") <= most))
        .withColumnRenamed("id_", "lender_"), "heads",
    )
    lent = ids.withColumn("lender_", lender).join(heads, "lender_").filter(F.col("place_") <= wanted)
    lengths = heads.groupBy("lender_").agg(F.max("place_").alias("lent_"))
    own = places.withColumn("lender_", lender).filter(F.col("place_") > wanted).join(lengths, "lender_", "left")
    shift = F.least(wanted, F.coalesce("lent_", F.lit(0))) - wanted
    turns = own.select("id_", (F.col("place_") + shift).alias("depth"), "m1", "m2", "chars").unionByName(
        lent.select("id_", F.col("place_").alias("depth"), "m1", "m2", "chars")
    )
    return ids, turns.withColumn("depth", F.col("depth").cast("long"))


def _places(x: np.ndarray, y: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of every prefix in each row of the sketch."""
    mask, half = np.uint64(cells - 1), np.uint64(32)
    x, y = x.view(np.uint64), y.view(np.uint64)
    return [(part & mask).astype(np.int64) for part in (x, x >> half, y, y >> half)]


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(name).to_numpy(zero_copy_only=False) for name in names]


def shared_cells(prefixes: DataFrame, cells: int) -> bytes:
    """The sketch of all prefixes (lx, ly), as one bit a cell: more than one prefix fell there.

    Tasks count their own prefixes up to two, which is all that matters; slices of their tables
    are added up one after the other.
    """
    schema = T.StructType([T.StructField("slice_", T.IntegerType()), T.StructField("counts", T.BinaryType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((4, cells), np.uint8)
        for batch in batches:
            for row, place in zip(table, _places(*_numbers(batch, "lx", "ly"), cells)):
                place, n = np.unique(place, return_counts=True)
                row[place] = np.minimum(row[place] + np.minimum(n, 2), 2)
        table = table.reshape(-1, min(cells, _SLICE))
        for at in np.flatnonzero(table.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([
                pa.array([at], pa.int32()),
                pa.array([pa.compress(table[at].tobytes(), codec="zstd", asbytes=True)], pa.binary()),
            ], names=schema.names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([current], pa.int32()), pa.array([np.packbits(total > 1).tobytes()], pa.binary()),
            ], names=schema.names)

        for batch in batches:
            for at, counts in zip(*(column.to_pylist() for column in batch.columns)):
                if current is not None and at != current:
                    yield done()
                if at != current:
                    current, total = at, np.zeros(min(cells, _SLICE), np.uint8)
                part = pa.decompress(counts, decompressed_size=len(total), codec="zstd", asbytes=True)
                total = np.minimum(total + np.frombuffer(part, np.uint8), 2)
        if current is not None:
            yield done()

    counted = prefixes.select("lx", "ly").mapInArrow(count, schema)
    summed = counted.repartition("slice_").sortWithinPartitions("slice_").mapInArrow(add, schema)
    width = min(cells, _SLICE) // 8
    bits = bytearray(4 * cells // 8)
    # As many rows as the sketch has slices, whatever the table.
    for row in summed.collect():
        bits[row["slice_"] * width:(row["slice_"] + 1) * width] = row["counts"]
    return bytes(bits)


SHARED, FIRST_ALONE, ALONE = 0, 1, 2


def screened(prefixes: DataFrame, bits: bytes, cells: int) -> DataFrame:
    """``prefixes`` with ``kind``: possibly shared, the first that is not, or after a singleton.

    (lx, ly) stand for the prefix, (px, py) for the one before it.
    """
    schema = T.StructType([*prefixes.schema.fields, T.StructField("kind", T.IntegerType())])
    sent = prefixes.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(sent.value, np.uint8).reshape(4, -1)

        def may_be_shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            found = np.ones(len(x), bool)
            for row, place in zip(table, _places(x, y, cells)):
                found &= (row[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool)
            return found

        for batch in batches:
            lx, ly, px, py, depth = _numbers(batch, "lx", "ly", "px", "py", "depth")
            own = may_be_shared(lx, ly) | (depth == 0)
            before = may_be_shared(px, py) | (depth <= 1)
            kind = np.where(before, np.where(own, SHARED, FIRST_ALONE), ALONE).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kind)], names=schema.names)

    return prefixes.mapInArrow(run, schema)


def prefixes_of(ids: DataFrame, turns: DataFrame, chunk: int = CHUNK_TURNS) -> tuple[DataFrame, DataFrame]:
    """All prefixes of all conversations, and the conversations of more than one chunk.

    Prefixes are (id_, chunk_, depth, lx, ly, px, py, chars, last): their own digest, that of the
    prefix before, the code points of the last text, and whether the conversation ends there.
    The empty prefix has depth 0.
    """
    rows = turns.select(
        "id_", "depth", F.xxhash64("m1", "depth").alias("x"), F.xxhash64("m2", F.lit(7), "depth").alias("y"),
        "chars",
    ).unionByName(ids.select(
        "id_", *[F.lit(0).cast("long").alias(c) for c in ("depth", "x", "y", "chars")]
    )).withColumn("chunk_", F.floor(F.col("depth") / chunk))
    inside = W.partitionBy("id_", "chunk_").orderBy("depth")
    so_far = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = held(rows.select(
        "id_", "chunk_", "depth", "x", "y", "chars",
        F.bit_xor("x").over(so_far).alias("lx"), F.bit_xor("y").over(so_far).alias("ly"),
        F.lead("depth").over(inside).isNull().alias("last"),
    ), "prefixes")
    long_ids = held(local.filter("chunk_ > 0").select("id_").distinct(), "long_ids")
    sums = local.join(long_ids, "id_", "left_semi").groupBy("id_", "chunk_").agg(
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")
    )
    chunks = W.partitionBy("id_").orderBy("chunk_")
    earlier = chunks.rowsBetween(W.unboundedPreceding, -1)
    carried = held(sums.select(
        "id_", "chunk_", F.bit_xor("x").over(earlier).alias("bx"), F.bit_xor("y").over(earlier).alias("by"),
        F.lead("chunk_").over(chunks).isNotNull().alias("goes_on"),
    ), "carried")
    whole = local.join(carried, ["id_", "chunk_"], "left").withColumns({
        "lx": F.col("lx").bitwiseXOR(F.coalesce("bx", F.lit(0))),
        "ly": F.col("ly").bitwiseXOR(F.coalesce("by", F.lit(0))),
    })
    return whole.select(
        "id_", "chunk_", "depth", "lx", "ly", F.col("lx").bitwiseXOR(F.col("x")).alias("px"),
        F.col("ly").bitwiseXOR(F.col("y")).alias("py"), "chars",
        (F.col("last") & ~F.coalesce("goes_on", F.lit(False))).alias("last"),
    ), long_ids


def id_digests(ends: DataFrame) -> DataFrame:
    """Of every (depth, lx, ly) the SHA-256 of its ids in ascending order, joined by commas.

    A digest has one order of bytes, so one task hashes it, from a stream; the text of a large
    group is put together by ranges first, so that the task reads few rows.
    """
    spark = ends.sparkSession
    keys = T.StructType([ends.schema[name] for name in _PREFIX])
    pieces = T.StructType([*keys, ends.schema["id_"], T.StructField("piece", T.StringType())])
    hashes = T.StructType([*keys, T.StructField("ends_sha256", T.StringType())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, names, start = [], list(zip(*(batch.column(c).to_pylist() for c in _PREFIX))), 0
            own = batch.column("id_").to_pylist()
            for at in range(1, len(names) + 1):
                if at == len(names) or names[at] != names[start] or at - start == PIECE_IDS:
                    found.append((*names[start], own[start], ",".join(map(str, own[start:at]))))
                    start = at
            yield pa.RecordBatch.from_arrays([
                pa.array([row[i] for row in found], kind)
                for i, kind in enumerate([*(batch.column(c).type for c in (*_PREFIX, "id_")), pa.string()])
            ], names=pieces.names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            done = []
            for *name, piece in zip(*(batch.column(c).to_pylist() for c in (*_PREFIX, "piece"))):
                if name != current:
                    if current is not None:
                        done.append((*current, state.hexdigest()))
                    current, state = name, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            yield _digest_rows(done)
        if current is not None:
            yield _digest_rows([(*current, state.hexdigest())])

    def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([row[i] for row in rows], pa.int64()) for i in range(3)]
            + [pa.array([row[3] for row in rows], pa.string())], names=hashes.names,
        )

    order = [*_PREFIX, "id_"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = ends.select(*order).repartitionByRange(tasks, *order).sortWithinPartitions(*order) \
        .mapInArrow(join, pieces)
    return joined.repartition(*_PREFIX).sortWithinPartitions(*order) \
        .select(*_PREFIX, "piece").mapInArrow(digest, hashes)


def _subtree_sums(path: DataFrame, long_ids: DataFrame, chunk: int) -> DataFrame:
    """``path`` with parent (the representative before), child, saved and leaf of every row.

    ``child``: the conversation represents the next node, too. ``saved``: tokens saved by the nodes
    that it represents from here on. ``leaf``: it represents a node without children.
    """
    own = F.when(F.col("node_id") == F.col("id_"), (F.col("n") - 1) * F.col("chars")).otherwise(0)
    ends_alone = (F.col("n") == 1) | (
        F.col("last") & (F.col("node_id") == F.col("id_")) & (F.col("n_ends") == F.col("n"))
    )
    path = path.withColumns({"own": own, "ends_alone": ends_alone})
    sums = path.join(long_ids, "id_", "left_semi").groupBy("id_", "chunk_").agg(
        F.sum("own").alias("own"), F.max("ends_alone").alias("any")
    )
    chunks = W.partitionBy("id_").orderBy("chunk_")
    later = held(sums.select(
        "id_", "chunk_", F.sum("own").over(chunks.rowsBetween(1, W.unboundedFollowing)).alias("later"),
        F.max("any").over(W.partitionBy("id_")).alias("any"),
    ), "later")
    # Rows next to a border of chunks are also seen by the chunk beyond it.
    seen_by = F.array_compact(F.array(
        F.col("chunk_"),
        F.when((F.col("depth") > 0) & (F.col("depth") % chunk == 0), F.col("chunk_") - 1),
        F.when(F.col("depth") % chunk == chunk - 1, F.col("chunk_") + 1),
    ))
    near = W.partitionBy("id_", "seen_by").orderBy("depth")
    here = F.col("seen_by") == F.col("chunk_")
    rows = path.withColumn("seen_by", F.explode(seen_by)).withColumns({
        "parent": F.when(F.col("depth") > 0, F.when(
            F.lag("depth").over(near) == F.col("depth") - 1, F.lag("node_id").over(near)
        ).otherwise(F.col("id_"))),
        "child": F.coalesce(
            (F.lead("depth").over(near) == F.col("depth") + 1) & (F.lead("node_id").over(near) == F.col("id_")),
            F.lit(False),
        ),
        "saved": F.sum(F.when(here, F.col("own")).otherwise(0)).over(
            near.rowsBetween(W.currentRow, W.unboundedFollowing)
        ),
        "leaf": F.max("ends_alone").over(near.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
    }).filter(here)
    return rows.join(later, ["id_", "chunk_"], "left").withColumns({
        "saved": F.col("saved") + F.coalesce("later", F.lit(0)),
        "leaf": F.col("leaf") | F.coalesce("any", F.lit(False)),
    })


def prefix_trie(
    ids: DataFrame, turns: DataFrame, chunk: int = CHUNK_TURNS, most_cells: int = MOST_CELLS,
) -> DataFrame:
    """One row per distinct prefix of the conversations ``ids`` (id_) with ``turns``.

    ``turns`` are (id_, depth, m1, m2, chars) with depths 1, 2, ... in every conversation. Output,
    all long but the digest: conv_id (smallest member), depth, parent_conv_id (the parent's
    conv_id; null at the root), n_convs (members), n_children, n_leaves (nodes without children in
    the subtree), saved_tokens (over the subtree: members less one, times the code points of the
    node's last text), ends_sha256 (the ids of members that end here).

    Ids are distinct and not null. Conversations without turns belong to the root and end there.
    Without conversations there are no nodes. Prefixes are compared by 128 bits.
    """
    found, long_ids = prefixes_of(ids, turns, chunk)
    cells = _LEAST_CELLS
    rows = found.count()
    while cells < min(4 * rows, most_cells):
        cells *= 2
    found = held(screened(found, shared_cells(found, cells), cells), "screened")
    shared = found.filter(F.col("kind") == SHARED)
    nodes = held(shared.groupBy(*_PREFIX).agg(
        F.min("id_").alias("node_id"), F.count("*").alias("n"), F.count_if("last").alias("n_ends")
    ), "nodes")
    root = nodes.filter("depth = 0").first()
    path = ["id_", "chunk_", *_PREFIX, "chars", "last", "node_id", "n", "n_ends"]
    # All conversations are in the root, so it is told to its rows and not joined.
    begun = shared.filter("depth = 0").withColumns({
        name: F.lit(root[name] if root else None).cast("long") for name in ("node_id", "n", "n_ends")
    })
    alone = found.filter(F.col("kind") == FIRST_ALONE).withColumns({
        "node_id": F.col("id_"), "n": F.lit(1).cast("long"), "n_ends": F.col("last").cast("long"),
    })
    members = shared.filter("depth > 0").join(nodes.filter("depth > 0"), _PREFIX)
    path = held(
        members.select(*path).unionByName(begun.select(*path)).unionByName(alone.select(*path)), "path"
    )
    rows = held(_subtree_sums(path, long_ids, chunk), "subtrees")
    digests = id_digests(rows.filter("last AND n > 1"))
    groups = rows.filter("n > 1").groupBy(*_PREFIX).agg(
        F.min("id_").alias("conv_id"), F.min("parent").alias("parent_conv_id"),
        F.count("*").alias("n_convs"), F.count_if("child").alias("n_children"),
        F.count_if("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    ).join(digests, _PREFIX, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_IDS)))

    def single(rows: DataFrame, parent: Column) -> DataFrame:
        own_id = F.sha2(F.col("id_").cast("string").cast("binary"), 256)
        return rows.select(
            F.col("id_").alias("conv_id"), "depth", parent.alias("parent_conv_id"),
            F.lit(1).alias("n_convs"), (~F.col("last")).cast("long").alias("n_children"),
            F.lit(1).alias("n_leaves"), F.lit(0).alias("saved_tokens"),
            F.when(F.col("last"), own_id).otherwise(F.lit(_NO_IDS)).alias("ends_sha256"),
        )

    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    every = groups.select(*names, "ends_sha256").unionByName(
        single(rows.filter("n = 1"), F.col("parent"))
    ).unionByName(single(found.filter(F.col("kind") == ALONE), F.col("id_")))
    return every.select(*[F.col(name).cast("long").alias(name) for name in names], "ends_sha256")
