"""Exact integer k-means: centroids in a vantage-point tree, searched best first.

Each round the driver builds a tree over the centroids, a table whose size does not depend on the
number of vectors, and sends it to the tasks. A node holds a vantage centroid and, of the
centroids nearer and farther than its median, the least and largest distance from it; leaves are
single centroids. The triangle inequality bounds a vector's distance to everything below a node.
A vector opens the nodes in the order of these bounds and ends when the smallest open one is
beyond its best distance. A bound equal to it is still opened, so that of equally near centroids
the one of the smallest number wins. Distances are compared as exact integers; bounds, which need
square roots, are taken a little too small.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.common import held

#: Components beyond this make distances that no long can hold; such vectors are left out.
MOST_COMPONENT = 1 << 26
#: How much too small bounds are taken, of the distances that they come from.
SLACK = 1e-9
#: Vectors that a task searches at a time.
BATCH_VECTORS = 4096


@dataclass
class VantageTree:
    """Nodes as parallel arrays. Children are given by number, -1 if there is none.

    ``low`` and ``high`` of a node bound the distances of its centroids from the vantage
    centroid of its parent.
    """

    centroids: np.ndarray
    vantage: list[int]
    children: list[tuple[int, int]]
    low: list[float]
    high: list[float]

    @classmethod
    def build(cls, centroids: np.ndarray) -> VantageTree:
        tree = cls(centroids, [], [], [], [])
        if len(centroids):
            tree._add(np.arange(len(centroids)), 0.0, 0.0)
        return tree

    def _add(self, members: np.ndarray, low: float, high: float) -> int:
        """The node of ``members``; equal distances may fall on both sides of the median."""
        number = len(self.vantage)
        self.vantage.append(int(members[0]))
        self.children.append((-1, -1))
        self.low.append(low)
        self.high.append(high)
        rest = members[1:]
        if len(rest):
            apart = np.sqrt(squared(self.centroids[rest], self.centroids[members[0]]).astype(float))
            order = np.argsort(apart, kind="stable")
            half = (len(rest) + 1) // 2
            self.children[number] = tuple(
                self._add(rest[part], float(apart[part].min()), float(apart[part].max())) if len(part) else -1
                for part in (order[:half], order[half:])
            )
        return number

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of every vector, the smaller number of equals, and the squared distance."""
        n, nodes = len(vectors), len(self.vantage)
        best = np.full(n, np.iinfo(np.int64).max)
        nearest = np.full(n, -1, np.int64)
        if not n or not nodes:
            return nearest, best
        # Bounds of open nodes; infinite: not reached yet, or done.
        bound = np.full((n, nodes), np.inf)
        bound[:, 0] = 0.0
        active = np.arange(n)
        while len(active):
            node = bound[active].argmin(axis=1)
            least = bound[active, node]
            go_on = np.isfinite(least) & (least <= np.sqrt(best[active].astype(float)))
            active, node, least = active[go_on], node[go_on], least[go_on]
            for number in np.unique(node).tolist():
                rows = active[node == number]
                centroid = self.vantage[number]
                apart = squared(vectors[rows], self.centroids[centroid])
                better = (apart < best[rows]) | ((apart == best[rows]) & (centroid < nearest[rows]))
                best[rows[better]], nearest[rows[better]] = apart[better], centroid
                away = np.sqrt(apart.astype(float))
                inherited = bound[rows, number]
                bound[rows, number] = np.inf
                for child in self.children[number]:
                    if child >= 0:
                        low, high = self.low[child], self.high[child]
                        gap = np.maximum(low - away, away - high) - SLACK * (away + high) - SLACK
                        bound[rows, child] = np.maximum(inherited, gap)
        return nearest, best


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Squared distances as integers."""
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """Rows (id, ints): floor(scale * x) of every component, of vectors that can be compared.

    Left out are null vectors, those of another size, those with null or non-finite components,
    and those with components beyond ``MOST_COMPONENT`` once scaled.
    """
    x = F.col(vector_col).cast("array<double>")
    fits = lambda v: v.isNotNull() & (F.abs(v) <= F.lit(float(MOST_COMPONENT) / scale))
    return vectors.filter(
        (F.size(x) == size) & F.coalesce(F.forall(x, lambda v: F.coalesce(fits(v), F.lit(False))), F.lit(False))
    ).select(
        F.col(id_col).alias("id_"),
        F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("int")).alias("ints"),
    )


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.int64)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_VECTORS):
            yield batch.slice(at, BATCH_VECTORS)


def cluster_sums(vectors: DataFrame, tree: VantageTree) -> tuple[np.ndarray, np.ndarray]:
    """Of every cluster the number of its vectors and the sum of each component, as Python integers.

    Tasks send one row per cluster and component; so does Spark, whatever the number of vectors.
    """
    k, size = tree.centroids.shape
    schema = T.StructType([
        T.StructField("cell", T.IntegerType()), T.StructField("total", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, size + 1), np.int64)
        for batch in _parts(batches):
            ints = _matrix(batch, size)
            nearest, _ = tree.nearest(ints)
            order = np.argsort(nearest, kind="stable")
            clusters, starts = np.unique(nearest[order], return_index=True)
            total[clusters, :size] += np.add.reduceat(ints[order], starts, axis=0)
            total[clusters, size] += np.diff(np.r_[starts, len(order)])
        used = np.flatnonzero(np.repeat(total[:, size] > 0, size + 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total.ravel()[used])], names=schema.names
        )

    cells = vectors.select("ints").mapInArrow(run, schema)
    found = np.zeros(k * (size + 1), object)
    for row in cells.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        found[row["cell"]] = int(row["total"])
    found = found.reshape(k, size + 1)
    return found[:, size], found[:, :size]


def first_centroids(vectors: DataFrame, k: int, seed: int, size: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of seed and id; each task sends at most ``k``."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id_").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(key.alias("key"), "ints").orderBy("key", "ints").limit(k).collect()
    return np.array([row["ints"] for row in rows], np.int64).reshape(-1, size)


def centroid_clusters(
    vectors: DataFrame, k: int = 16, rounds: int = 3, id_col: str = "vec_id", vector_col: str = "embedding",
    size: int = 64, scale: int = 64, seed: int = 1,
) -> DataFrame:
    """One row per vector that can be compared: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors are taken as integers, floor(scale * x). The first centroids are the ``k`` vectors with the
    smallest SHA-256 of ``seed:id`` (equal hashes: the smaller components); a null id hashes as empty.
    Each round assigns every vector to its nearest centroid (ties: the smaller number) and moves each
    centroid that has vectors to the floor of their mean; then vectors are assigned once more.
    ``distance`` is squared; inertia is its sum over the cluster and over all.

    Null vectors, those of another size, with null or non-finite components or too large for a long are
    left out. Repeated rows count as often as they occur. With fewer vectors than ``k`` there are as many
    centroids as vectors; with none there are no rows. Other columns are not read.
    """
    ints = held(integer_vectors(vectors, id_col, vector_col, size, scale), "ints")
    centroids = first_centroids(ints, k, seed, size)
    for _ in range(rounds):
        n, sums = cluster_sums(ints, VantageTree.build(centroids))
        moved = centroids.copy()
        for cluster in np.flatnonzero(n).tolist():
            moved[cluster] = [total // n[cluster] for total in sums[cluster]]
        centroids = moved
    tree = VantageTree.build(centroids)
    schema = T.StructType([
        ints.schema["id_"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            nearest, best = tree.nearest(_matrix(batch, size))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id_"), pa.array(nearest.astype(np.int32)), pa.array(best)], names=schema.names
            )

    assigned = held(ints.mapInArrow(run, schema), "assigned")
    by_cluster = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # One row per cluster at most.
    sums = {row["cluster"]: row["cluster_inertia"] for row in by_cluster.collect()}
    table = assigned.sparkSession.createDataFrame([
        (cluster, total, hashlib.sha256(",".join(map(str, centroids[cluster].tolist())).encode()).hexdigest())
        for cluster, total in sorted(sums.items())
    ], "cluster int, cluster_inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select(
        F.col("id_").alias(id_col), "cluster", "distance", "cluster_inertia",
        F.lit(sum(sums.values())).cast("long").alias("inertia"), "centroid_sha256",
    )
