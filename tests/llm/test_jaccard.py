import random

import numpy as np
import pytest
from helpers import frame, linked, odd_rows, roots, row, shingles

from rillflow.llm import jaccard


def expected(rows, words, num, den):
    sets = [shingles(r[1], words) for r in rows]
    classes = roots(len(rows), linked(sets, num, den))
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if classes[j] == classes[i]]
        known = [x for x in ids if x is not None]
        out.append((r[0], len(sets[i]), r[0] if not sets[i] else min(known, default=None)))
    return sorted(out, key=repr)


def near_copies(seed, bases=6, copies=14):
    rng = random.Random(seed)
    rows, number = [], 100
    for _ in range(bases):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 9, 40, 120]))]
        for _ in range(copies):
            own = [w if rng.random() > 0.02 else f"x{rng.randrange(99)}" for w in words]
            rows.append(row(number, " ".join(own)))
            number += 1
    return rows


@pytest.mark.parametrize("task_tokens", [4_000_000, 300])
def test_all_links(spark, task_tokens):
    rows = odd_rows() + near_copies(1)
    found = jaccard.jaccard_components(frame(spark, rows), 4, 85, 100, task_tokens=task_tokens)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows, 4, 85, 100)


def test_one_stays_and_empty(spark):
    rows = near_copies(2, 3, 6) + [row(1, None)]
    kept = jaccard.one_per_component(frame(spark, rows))
    want = {c for i, _, c in expected(rows, 5, 80, 100) if i == c}
    assert {r["doc_id"] for r in kept.collect()} == want
    assert kept.columns == frame(spark, []).columns
    assert jaccard.jaccard_components(frame(spark, [])).count() == 0


def test_signatures_meet():
    """Any two sets similar enough share a signature, at all sizes and at the border."""
    rng = np.random.default_rng(4)
    for num, den in ((85, 100), (80, 100), (50, 100)):
        for n in [*range(1, 70), 255, 256, 257, 500, 1100]:
            one = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            for _ in range(4):
                drop = rng.integers(0, max(1, n * (den - num) // den) + 1)
                add = rng.integers(0, max(1, n * (den - num) // den) + 1)
                two = np.unique(np.r_[
                    rng.permutation(one)[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)
                ])
                both = len(np.intersect1d(one, two))
                if den * both < num * (len(one) + len(two) - both) or np.array_equal(one, two):
                    continue
                a, b = (jaccard.signatures(x, num, den).tolist() for x in (one, two))
                assert set(a) & set(b), (n, num, drop, add)


def test_matrix_against_all_pairs():
    rng = np.random.default_rng(6)
    base = [np.unique(rng.integers(0, 4000, 60, dtype=np.uint64)) for _ in range(9)]
    sets = [np.unique(np.r_[rng.permutation(base[i % 9])[3:], rng.integers(0, 4000, 2, dtype=np.uint64)])
            for i in range(200)] + [np.zeros(0, np.uint64)]
    found = jaccard.linked_labels(sets, 85, 100)
    plain = roots(len(sets), linked([frozenset(s.tolist()) for s in sets], 85, 100))
    same = lambda labels: [[x == y for y in labels] for x in labels]
    assert same(found.tolist()) == same(plain)
