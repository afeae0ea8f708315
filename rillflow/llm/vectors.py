"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors are turned onto their principal axes, which keeps distances, and put in the
lexicographic order of their grid cells of width epsilon on the leading axes. The sequence
is cut into blocks. Intervals of blocks are joined recursively: a pair of intervals whose
boxes on the leading axes are more than epsilon apart is skipped with all blocks in it.
Only the surviving pairs of blocks are compared, in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.common import components, held

#: Vectors in a block, leading axes, and blocks of intervals under one interval above.
BLOCK_ROWS = 1024
AXES = 6
FANOUT = 8
SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small components stay finite.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Rows that can link: (id_, label_, vector, dim, h1, h2)."""
    v = F.col(vector_col)
    wide = F.transform(v, lambda x: x.cast("double"))
    good = F.coalesce(F.forall(
        wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    ) & F.exists(wide, lambda x: x != 0), F.lit(False))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & good).select(
        F.col(id_col).alias("id_"), F.col(label_col).alias("label_"), wide.alias("vector"),
        F.size(v).alias("dim"),
        F.xxhash64(F.lit(1), v).alias("h1"), F.xxhash64(F.lit(2), v).alias("h2"),
    )


def principal_axes(distinct: DataFrame, axes: int) -> dict[int, np.ndarray]:
    """The leading principal directions of the unit vectors of the commonest length.

    Moments are summed in the tasks and then by cell of the matrix, so the driver gets one
    number for each cell. Other lengths use their first coordinates.
    """
    top = distinct.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if top is None:
        return {}
    d = top["dim"]
    schema = T.StructType([
        T.StructField("cell", T.IntegerType()), T.StructField("total", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d + 1))
        for batch in batches:
            if batch.num_rows:
                rows = _unit(_matrix(batch.column("vector")))
                rows = np.c_[rows, np.ones(len(rows))]
                total += rows.T @ rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())],
            names=schema.names,
        )

    cells = distinct.filter(F.col("dim") == d).select("vector").mapInArrow(run, schema)
    found = cells.groupBy("cell").agg(F.sum("total").alias("total")).collect()
    total = np.zeros((d + 1) * (d + 1))
    for row in found:
        total[row["cell"]] = row["total"]
    total = total.reshape(d + 1, d + 1)
    mean = total[d, :d] / total[d, d]
    _, directions = np.linalg.eigh(total[:d, :d] / total[d, d] - np.outer(mean, mean))
    return {d: np.ascontiguousarray(directions[:, ::-1][:, :axes])}


def grid_blocks(distinct: DataFrame, eps: float, axes: int, block_rows: int) -> DataFrame:
    """The vectors in grid order, as one row per block with its box on the leading axes.

    A last hash key lets a range boundary fall inside a crowded cell.
    """
    turned = principal_axes(distinct, axes)
    placed_schema = T.StructType([
        *distinct.schema.fields,
        T.StructField("place", T.ArrayType(T.DoubleType())),
        T.StructField("cells", T.ArrayType(T.LongType())),
    ])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for d in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == d))
                rows = _unit(_matrix(part.column("vector")))
                found = np.zeros((len(rows), axes))
                lead = rows @ turned[d] if d in turned else rows[:, :axes]
                found[:, :lead.shape[1]] = lead
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(list(found)),
                     pa.array(list(np.floor(found / eps).astype(np.int64)))],
                    names=placed_schema.names,
                )

    block_schema = T.StructType([
        T.StructField("task", T.LongType()), T.StructField("number", T.LongType()),
        distinct.schema["label_"], T.StructField("dim", T.IntegerType()),
        *[T.StructField(f"{end}{i}", T.DoubleType()) for end in ("lo", "hi") for i in range(axes)],
        T.StructField("h1s", T.ArrayType(T.LongType())), T.StructField("h2s", T.ArrayType(T.LongType())),
        T.StructField("copies", T.ArrayType(T.LongType())), T.StructField("vectors", T.BinaryType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys = list(zip(batch.column("label_").to_pylist(), batch.column("dim").to_pylist()))
            start = 0
            while start < len(keys):
                end = start
                while end < len(keys) and end - start < block_rows and keys[end] == keys[start]:
                    end += 1
                part = batch.slice(start, end - start)
                box = np.array(part.column("place").to_pylist())
                columns = [[task], [number], [keys[start][0]], [keys[start][1]]]
                columns += [[x] for x in box.min(axis=0)] + [[x] for x in box.max(axis=0)]
                columns += [[part.column(name).to_pylist()] for name in ("h1", "h2", "copies")]
                columns.append([_matrix(part.column("vector")).tobytes()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, type=t) for x, t in zip(columns, types)], names=block_schema.names
                )
                start, number = end, number + 1

    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(field.dataType) for field in block_schema.fields]
    order = ["label_", "dim", "cells", "h1", "h2"]
    placed = distinct.mapInArrow(place, placed_schema)
    blocks = held(
        placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, block_schema),
        "blocks",
    )
    step = (blocks.agg(F.max("number")).first()[0] or 0) + 1
    return blocks.withColumn("block", F.col("task") * step + F.col("number"))


def close_blocks(blocks: DataFrame, eps: float, axes: int) -> DataFrame:
    """Pairs (a, b) of blocks, a <= b, whose boxes are within ``eps``.

    Intervals are runs of ``FANOUT`` intervals below. Going down from the whole sequence of
    a label, the children of surviving pairs are paired and tested, so what one test skips
    is never listed.
    """
    ends = [f"lo{i}" for i in range(axes)], [f"hi{i}" for i in range(axes)]
    level = blocks.select("label_", "dim", F.col("block").alias("at"), *ends[0], *ends[1])
    levels = [held(level, "intervals")]
    top = levels[0].agg(F.max("at")).first()[0] or 0
    while top:
        top //= FANOUT
        levels.append(held(
            levels[-1].groupBy("label_", "dim", F.floor(F.col("at") / FANOUT).alias("at")).agg(
                *[F.min(x).alias(x) for x in ends[0]], *[F.max(x).alias(x) for x in ends[1]]
            ), "intervals",
        ))
    pairs = levels[-1].select("label_", "dim", F.col("at").alias("a"), F.col("at").alias("b"))
    far = eps * eps + SLACK
    for level in levels[-2::-1]:
        def side(name: str, level: DataFrame = level) -> DataFrame:
            return level.select(
                F.col("label_").alias(f"{name}_label"), F.col("dim").alias(f"{name}_dim"),
                F.col("at").alias(f"{name}_at"), F.floor(F.col("at") / FANOUT).alias(f"{name}_up"),
                *[F.col(x).alias(f"{name}_{x}") for x in (*ends[0], *ends[1])],
            )

        gap = F.lit(0.0)
        for lo, hi in zip(*ends):
            apart = F.greatest(
                F.lit(0.0), F.col(f"x_{lo}") - F.col(f"y_{hi}"), F.col(f"y_{lo}") - F.col(f"x_{hi}")
            )
            gap = gap + apart * apart
        pairs = held(
            pairs.join(side("x"), (F.col("x_label") == F.col("label_"))
                       & (F.col("x_dim") == F.col("dim")) & (F.col("x_up") == F.col("a")))
            .join(side("y"), (F.col("y_label") == F.col("label_"))
                  & (F.col("y_dim") == F.col("dim")) & (F.col("y_up") == F.col("b")))
            .filter((F.col("x_at") <= F.col("y_at")) & (gap <= far))
            .select("label_", "dim", F.col("x_at").alias("a"), F.col("y_at").alias("b")),
            "pairs",
        )
    return pairs.select("a", "b")


PLACES = 1 << 20

LINKS = T.StructType([
    T.StructField("node", T.LongType()),
    T.StructField("links", T.LongType()),
    T.StructField("root", T.LongType()),
])


def _compare(pairs: DataFrame, cosine: float) -> DataFrame:
    """For each vector of a pair of blocks its links there and the smallest vector connected.

    One row per vector, however many links it has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = _links_of(row, cosine)
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in found], names=LINKS.names
                    )

    return pairs.mapInArrow(run, LINKS)


def _links_of(row: dict, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    d, same = row["dim"], row["a"] == row["b"]
    one = np.frombuffer(row["x_vectors"]).reshape(-1, d)
    two = one if same else np.frombuffer(row["y_vectors"]).reshape(-1, d)
    scale = [np.abs(x).max(axis=1, keepdims=True) for x in (one, two)]
    one, two = one / scale[0], two / scale[1]
    norms = [np.sqrt((x * x).sum(axis=1)) for x in (one, two)]
    near = (one @ two.T) / (norms[0][:, None] * norms[1][None, :]) >= cosine
    nodes = row["a"] * PLACES + np.arange(len(one))
    copies = np.array(row["x_copies"], np.int64)
    if same:
        np.fill_diagonal(near, False)
        links = near @ copies
        others, counts = nodes, links[:0]
    else:
        others = row["b"] * PLACES + np.arange(len(two))
        links = near @ np.array(row["y_copies"], np.int64)
        counts = near.T @ copies
    roots, other_roots = nodes.copy(), others.copy()
    none = np.iinfo(np.int64).max
    while True:
        # Labels run to the smallest along the links of the two blocks.
        left = np.minimum(roots, np.where(near, other_roots[None, :], none).min(axis=1))
        right = np.minimum(other_roots, np.where(near, left[:, None], none).min(axis=0))
        if same:
            left = right = np.minimum(left, right)
        if (left == roots).all() and (right == other_roots).all():
            break
        roots, other_roots = left, right
    if not same:
        nodes, links = np.r_[nodes, others], np.r_[links, counts]
        roots = np.r_[roots, other_roots]
    hit = links > 0
    return nodes[hit], links[hit], roots[hit]


def near_vectors(
    vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id",
    vector_col: str = "embedding", label_col: str = "label", block_rows: int = BLOCK_ROWS,
    axes: int = AXES,
) -> DataFrame:
    """One row per row of ``vectors``: its id, n_links, component_id and kept.

    Two vectors link if their labels are equal, their lengths are, and their cosine in
    double precision is ``cosine`` or more. ``n_links`` counts the other rows linked
    directly; ``component_id`` is the smallest id reachable; ``kept`` says whether the row
    has that id. Exact copies are brought together first and counted as many times as they
    occur, so no group is expanded into pairs.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows of
    null label or id, link with nothing: no links, their own id (null for null) and kept.
    Rows with the same id count like any others. Only the three named columns are read.
    """
    eps = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    rows = usable(vectors, id_col, vector_col, label_col)
    distinct = held(rows.groupBy("label_", "dim", "h1", "h2").agg(
        F.min("id_").alias("least"), F.count("*").alias("copies"),
        F.any_value("vector").alias("vector"),
    ), "vectors")
    blocks = grid_blocks(distinct.drop("least"), eps, axes, block_rows)
    pairs = close_blocks(blocks, eps, axes)
    x = blocks.select(F.col("block").alias("a"), "dim", F.col("copies").alias("x_copies"),
                      F.col("vectors").alias("x_vectors"))
    y = blocks.select(F.col("block").alias("b"), F.col("copies").alias("y_copies"),
                      F.col("vectors").alias("y_vectors"))
    links = held(_compare(pairs.join(x, "a").join(y, "b").repartition("a", "b"), cosine), "links")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    nodes = blocks.select("block", "label_", "dim", F.posexplode(F.arrays_zip("h1s", "h2s"))).select(
        (F.col("block") * PLACES + F.col("pos")).alias("node"), "label_", "dim",
        F.col("col.h1s").alias("h1"), F.col("col.h2s").alias("h2"),
    )
    known = held(
        distinct.join(nodes, ["label_", "dim", "h1", "h2"])
        .join(counts, "node", "left").join(classes, F.col("node") == F.col("id"), "left")
        .select("label_", "dim", "h1", "h2", "least", "copies",
                F.coalesce("links", F.lit(0)).alias("links"),
                F.coalesce("component", "node").alias("component")),
        "known",
    )
    smallest = known.groupBy("component").agg(F.min("least").alias("smallest"))
    known = known.join(smallest, "component").select(
        F.col("label_").alias("k_label"), F.col("dim").alias("k_dim"), F.col("h1").alias("k1"),
        F.col("h2").alias("k2"), (F.col("links") + F.col("copies") - 1).alias("n_links"), "smallest",
    )
    own = usable(vectors, id_col, vector_col, label_col).select("id_", "label_", "dim", "h1", "h2")
    linked = own.join(
        known, (F.col("label_") == F.col("k_label")) & (F.col("dim") == F.col("k_dim"))
        & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left",
    ).select(F.col("id_").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
             F.coalesce("smallest", "id_").alias("component_id"))
    v = F.col(vector_col)
    good = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                               & (F.abs(x.cast("double")) != F.lit(float("inf"))))
                      & F.exists(v, lambda x: x != 0), F.lit(False))
    alone = vectors.filter(F.col(id_col).isNull() | F.col(label_col).isNull() | ~good).select(
        id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.col(id_col).eqNullSafe(F.col("component_id"))
    )
