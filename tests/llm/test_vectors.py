import math

import numpy as np
import pytest
from helpers import roots
from pyspark.sql import types as T

from rillflow.llm import vectors

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("h1", T.StringType()),
])


def rows_of(seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        for _ in range(12):
            base = rng.normal(size=8)
            for _ in range(rng.integers(1, 12)):
                rows.append((base + rng.normal(size=8) * 0.08).astype(np.float32).tolist() + [label])
    rows = [(i, r[:-1], int(r[-1]), None) for i, r in enumerate(rows)]
    copy = rows[5]
    return rows + [
        (1000, copy[1], copy[2], "x"), (1001, copy[1], copy[2], "x"), (1001, copy[1], copy[2], "x"),
        (1002, copy[1], 1 - copy[2], "x"), (1003, copy[1], None, "x"), (1004, None, 0, "x"),
        (1005, [0.0] * 8, 0, "x"), (1006, [math.nan] * 8, 0, "x"), (1007, [1.0, None] * 4, 0, "x"),
        (1008, [math.inf] + [0.0] * 7, 0, "x"), (1009, [], 0, "x"), (1010, [1.0, 2.0], 0, "x"),
        (1011, [2.0, 4.0], 0, "x"), (1012, [2 * x for x in copy[1]], copy[2], "x"),
        (None, copy[1], copy[2], "x"),
    ]


def expected(rows, cosine):
    good = [
        i for i, (n, v, label, _) in enumerate(rows)
        if n is not None and label is not None and v and None not in v
        and all(map(math.isfinite, v)) and any(v)
    ]
    pairs = []
    for x in good:
        for y in good:
            a, b = rows[x], rows[y]
            if y < x and a[2] == b[2] and len(a[1]) == len(b[1]):
                p, q = np.array(a[1], float), np.array(b[1], float)
                if p @ q / (np.linalg.norm(p) * np.linalg.norm(q)) >= cosine:
                    pairs.append((x, y))
    classes = roots(len(rows), pairs)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if classes[j] == classes[i]]
        least = min([x for x in ids if x is not None], default=None)
        out.append((r[0], sum(i in p for p in pairs), least, r[0] == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_rows", [1024, 3])
def test_all_links(spark, block_rows):
    rows = rows_of()
    found = vectors.near_vectors(spark.createDataFrame(rows, SCHEMA), block_rows=block_rows)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows, 0.98)


def test_empty(spark):
    assert vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(1, None, 1, None)], SCHEMA)
    assert list(map(tuple, vectors.near_vectors(none).collect())) == [(1, 0, 1, True)]
