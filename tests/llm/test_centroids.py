import hashlib
import math
import random

import numpy as np

from rillflow.llm import centroids

VECTORS = "vec_id long, embedding array<double>, cluster string, distance string, ints string, id_ string"


def clusters(rows, k, rounds, size, scale, seed):
    """The contract, step by step, over lists of integers."""
    kept = [
        (vec_id, [math.floor(scale * x) for x in v]) for vec_id, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda row: (hashlib.sha256(f"{seed}:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1])
    centers = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centers))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centers = [
            [sum(xs) // len(members[i]) for xs in zip(*members[i])] if i in members else c
            for i, c in enumerate(centers)
        ]
    found = [(vec_id, *nearest(v)) for vec_id, v in kept]
    inertia = {i: sum(d for _, d, j in found if j == i) for i in range(k)}
    return sorted(
        (vec_id, i, d, inertia[i], sum(inertia.values()),
         hashlib.sha256(",".join(map(str, centers[i])).encode()).hexdigest())
        for vec_id, d, i in found
    )


def clustered(spark, rows, **options):
    df = spark.createDataFrame([(*row, "x", "x", "x", "x") for row in rows], VECTORS)
    found = centroids.centroid_clusters(df, **options)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, found.collect()), key=lambda row: (row[0] is not None, row))


def test_clusters_are_those_of_a_plain_search(spark):
    rng = random.Random(4)
    # Few values: many equal distances and equal vectors.
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 2.25]) for _ in range(3)]) for i in range(400)]
    rows += [(1, [0.0, 0.0, 0.0])] * 2 + [(7, None), (8, []), (9, [1.0, None, 0.0]), (10, [1.0, float("nan"), 0.0])]
    rows += [(11, [float("inf"), 0.0, 0.0]), (12, [1.0, 2.0]), (13, [-1e5, 1e5, 0.1])]
    options = {"k": 9, "rounds": 3, "size": 3, "scale": 64, "seed": 1}
    assert clustered(spark, rows, **options) == clusters(rows, **options)


def test_few_vectors_and_none(spark):
    options = {"k": 16, "rounds": 2, "size": 2, "scale": 64, "seed": 1}
    assert clustered(spark, [], **options) == []
    assert clustered(spark, [(1, None)], **options) == []
    rows = [(5, [0.1, -0.1]), (6, [0.1, -0.1]), (7, [9.0, 9.0])]
    assert clustered(spark, rows, **options) == clusters(rows, **options)
    lost = clustered(spark, [(None, [0.0, 1.0]), (None, [0.0, 1.0])], **options)
    assert [row[:3] for row in lost] == [(None, 0, 0)] * 2
    # Beyond what distances in a long can hold.
    assert clustered(spark, [(1, [1e30, 0.0]), (2, [0.0, 0.0])], **options)[0][0] == 2


def test_tree_search_is_exact_and_skips_most(monkeypatch):
    rng = np.random.default_rng(2)
    centers = rng.integers(-300, 300, (200, 4))
    centers[50] = centers[3]
    tree = centroids.VantageTree.build(centers)
    vectors = np.concatenate([rng.integers(-320, 320, (500, 4)), centers])
    apart = ((vectors[:, None] - centers[None]) ** 2).sum(axis=2)
    seen = []
    plain = centroids.squared
    monkeypatch.setattr(centroids, "squared", lambda v, c: seen.append(len(v)) or plain(v, c))
    nearest, best = tree.nearest(vectors)
    assert (nearest == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()
    assert sum(seen) < apart.size / 2
    # Every centroid is one node.
    assert sorted(tree.vantage) == list(range(200))


def test_equal_distances_go_to_the_smaller_number():
    centers = np.array([[4, 0], [0, 4], [-4, 0], [0, -4], [4, 0]])
    nearest, best = centroids.VantageTree.build(centers).nearest(np.array([[0, 0], [4, 0], [1, 1]]))
    assert nearest.tolist() == [0, 0, 0] and best.tolist() == [16, 0, 10]
