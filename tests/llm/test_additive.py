import math

import numpy as np
import pyarrow as pa
import pytest
from helpers import WORD, frame, lowered, odd_rows
from pyspark.sql import functions as F

from rillflow.llm import additive
from rillflow.llm.common import crc_remainder

DIR = "/root/testdata/sf0.01"


def plain_features(text):
    text = text or ""
    words = WORD.findall(lowered(text))
    lines = [line.strip() for line in text.encode().split(b"\n") if line.strip()]
    share = lambda part, whole: part / whole if whole else 0.0
    count = lambda some: sum(text.count(c) for c in some)
    upper = sum("A" <= c <= "Z" for c in text)
    lower = sum("a" <= c <= "z" for c in text)
    spaces = count(" \t\r") + count("\n")
    data = text.encode()
    doubled = sum(a == b and b != 32 for a, b in zip(data, data[1:]))
    return [
        math.log1p(len(text)), math.log1p(len(words)), share(len(text) - spaces, len(words)),
        share(upper, upper + lower), share(sum("0" <= c <= "9" for c in text), len(text)),
        share(count("#*$%&<>~^=_{}[]\\/@+"), len(text)), share(count("!"), len(text)), share(count("|"), len(text)),
        share(count(".,;:?"), len(text)), share(sum(ord(c) > 127 for c in text), len(text)),
        share(spaces, len(text)),
        share(sum((ord(c) < 32 and c not in "\t\r\n") or ord(c) == 127 for c in text), len(text)),
        share(doubled, len(text)), share(len(set(words)), len(words)),
        share(max(map(words.count, set(words)), default=0), len(words)),
        share(sum(a == b for a, b in zip(words, words[1:])), len(words)), math.log1p(len(lines)),
        share(len(set(lines)), len(lines)), share(sum(x[-1:] in b".!?:\"'" for x in lines), len(lines)),
        math.log1p(max(map(len, lines), default=0)),
    ]


def test_features_are_the_plain_ones():
    texts = [row[1] for row in odd_rows()] + ["a a a B\n\na!", "||\x00\x7f 12,5%", "", "x"]
    found = additive.text_features(pa.array(texts))
    assert found.shape == (len(texts), len(additive.FEATURES))
    np.testing.assert_allclose(found, [plain_features(text) for text in texts], atol=1e-12)


def known_rows(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    rows = rng.random((n, 3))
    odds = 4 * (rows[:, 0] > 0.6) - 2 + 4 * ((rows[:, 1] > 0.5) ^ (rows[:, 2] > 0.5)) - 2
    return rows, (rng.random(n) < 1 / (1 + np.exp(-odds))).astype(float), odds


def test_scores_are_sums_of_table_entries():
    rows, labels, _ = known_rows()
    model = additive.fit(rows, labels, rounds=10, pair_rounds=5)
    for row, odds in zip(rows[:50], model.log_odds(rows[:50])):
        plain = model.start
        for f, table in enumerate(model.tables):
            plain += table[sum(edge <= row[f] for edge in model.edges[f])]
        for (a, b), table in model.pairs.items():
            plain += table[
                sum(edge <= row[a] for edge in model.coarse[a]), sum(edge <= row[b] for edge in model.coarse[b])
            ]
        assert abs(plain - odds) < 1e-9


def test_pairs_find_what_single_features_cannot():
    rows, labels, odds = known_rows()
    model = additive.fit(rows, labels)
    assert next(iter(model.pairs)) == (1, 2)
    alone = additive.fit(rows, labels, most_pairs=0)
    new, _, truth = known_rows(seed=2)
    apart = lambda m: np.corrcoef(m.log_odds(new), truth)[0, 1]
    assert apart(model) > 0.95 > apart(alone) + 0.1


def test_trees_are_the_best_ones():
    rng = np.random.default_rng(5)
    grad, hess = rng.normal(size=(5, 4)), rng.random((5, 4)) + 0.1
    value = lambda g, h: g.sum() ** 2 / (h.sum() + 1.0)
    best = max(
        sum(value(grad[a, b], hess[a, b]) for a in (slice(i), slice(i, 5)) for b in (slice(j), slice(j, 4)))
        for i in range(1, 5) for j in range(1, 4)
    )
    gain, step = additive.crossed_tree(grad, hess, 1.0)
    assert gain == pytest.approx(best - value(grad, hess))
    assert gain == pytest.approx(-(2 * step * grad + step ** 2 * hess).sum() - sum(
        s ** 2 for s in np.unique(step)
    ) - value(grad, hess))
    g, h = grad[:, 0], hess[:, 0]
    cut = max(range(1, 5), key=lambda i: value(g[:i], h[:i]) + value(g[i:], h[i:]))
    step = additive.shallow_tree(g, h, 1, 1.0)
    assert np.allclose(step, [-g[:cut].sum() / (h[:cut].sum() + 1)] * cut
                       + [-g[cut:].sum() / (h[cut:].sum() + 1)] * (5 - cut))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{name}.parquet") for name in ("documents", "labels"))
    held_out = crc_remainder("doc_id", 5) == 0
    model = additive.train(docs, labels, ~held_out)
    rows = additive.score(docs, model).join(labels, "doc_id").filter(held_out).collect()
    good = [row["score"] for row in rows if row["quality"] == 1]
    bad = [row["score"] for row in rows if row["quality"] == 0]
    assert len(bad) > 3
    right = np.mean([(a > b) + (a == b) / 2 for a in good for b in bad])
    assert right > 0.95
    assert np.mean([x >= 0.3 for x in good]) > 0.95
    # Labels of what was held out change nothing.
    other = labels.withColumn("quality", F.when(held_out, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = additive.train(docs, other, ~held_out)
    rows = np.random.default_rng(0).random((40, len(additive.FEATURES)))
    assert (again.scores(rows) == model.scores(rows)).all()


def test_odd_rows_and_bounds(spark):
    docs = frame(spark, odd_rows())
    none = spark.createDataFrame([(1, None), (None, 1), (99, 1)], "doc_id long, quality int")
    model = additive.train(docs, none, F.lit(True))
    assert {row["score"] for row in additive.score(docs, model).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] * 2, "doc_id long, quality int")
    model = additive.train(docs, labels, F.lit(True), max_rows=10)
    found = additive.score(docs, model)
    assert found.columns == ["doc_id", "score"] and found.count() == docs.count()
    assert all(0 <= row["score"] <= 1 for row in found.collect())
    assert additive.score(frame(spark, []), model).collect() == []
    empty = additive.train(frame(spark, []), labels, F.lit(True))
    assert empty.scores(np.zeros((1, len(additive.FEATURES))))[0] == 0.5
