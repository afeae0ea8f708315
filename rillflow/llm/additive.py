"""Quality of texts by a generalised additive model with pairwise interactions.

A text is a few numbers: shares of kinds of characters, repeated words and lines, lengths. Each
number falls into a bin, and each bin adds its entry of a lookup table to the log odds. The tables
are learned by cyclic boosting: one shallow tree per feature in turn, fitted to what is left of
the labels, its leaves added to the feature's table. Then the pairs of features that explain most
of the rest get tables of two dimensions, learned the same way by trees that cut both features.

The model is fitted on the driver from a bounded number of labelled texts (``max_rows``); tasks
score whole texts by adding bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.common import batched, slices, text_parts, word_hashes

#: Labelled rows that a model is fitted on at most.
MAX_ROWS = 20_000
FEATURES = [
    "log_chars", "log_words", "word_length", "upper_share", "digit_share", "symbol_share", "shout_share",
    "bar_share", "mark_share", "foreign_share", "space_share", "control_share", "doubled_share",
    "distinct_word_share", "top_word_share", "echo_share", "log_lines", "distinct_line_share",
    "ended_line_share", "log_longest_line",
]

_UPPER, _LOWER, _DIGIT, _SPACE, _NEWLINE, _SYMBOL, _SHOUT, _BAR, _MARK, _LEAD, _INNER, _CONTROL = range(1, 13)


def _kinds() -> np.ndarray:
    """The kind of every byte; letters beyond ASCII count by their first byte."""
    kind = np.zeros(256, np.uint8)
    kind[:32], kind[127] = _CONTROL, _CONTROL
    for name, members in (
        (_UPPER, range(65, 91)), (_LOWER, range(97, 123)), (_DIGIT, range(48, 58)), (_SPACE, b" \t\r"),
        (_NEWLINE, b"\n"), (_SYMBOL, b"#*$%&<>~^=_{}[]\\/@+"), (_SHOUT, b"!"), (_BAR, b"|"),
        (_MARK, b".,;:?"), (_LEAD, range(192, 256)), (_INNER, range(128, 192)),
    ):
        kind[list(members)] = name
    return kind


_KIND = _kinds()


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the offsets ``at``; nothing between equal ones."""
    found = np.zeros(len(at) - 1, np.int64)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        found[some] = np.add.reduceat(values, at[some], dtype=np.int64)
    return found


def _word_counts(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every text its distinct words, the uses of its most frequent one, and words equal to the last."""
    texts = len(counts)
    distinct, top, echoes = np.zeros(texts), np.zeros(texts), np.zeros(texts)
    if len(hashes):
        text = np.repeat(np.arange(texts), counts)
        same = np.r_[False, (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])]
        echoes = np.bincount(text[same], minlength=texts)
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])])
        distinct = np.bincount(text[first], minlength=texts)
        np.maximum.at(top, text[first], np.diff(np.r_[first, len(hashes)]))
    return distinct, top, echoes


def _line_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of every text its lines with something in them, distinct ones, ended ones, and the longest in bytes."""
    found = np.zeros((len(at) - 1, 4))
    raw = data.tobytes()
    for i, (start, end) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        lines = [line for line in map(bytes.strip, raw[start:end].split(b"\n")) if line]
        if lines:
            found[i] = (len(lines), len(set(lines)), sum(line[-1] in b".!?:\"'" for line in lines),
                        max(map(len, lines)))
    return found


def text_features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text. Null and empty texts have no characters: zeros."""
    data, at = text_parts(column)
    kind = _KIND[data]
    n = {name: _sums(kind == name, at).astype(float) for name in range(1, 13)}
    chars = np.diff(at) - n[_INNER]
    hashes, words = word_hashes(data, at)
    distinct, top, echoes = _word_counts(hashes, words)
    lines = _line_counts(data, at)
    doubled = np.zeros(len(data), bool)
    doubled[1:] = (data[1:] == data[:-1]) & (data[1:] != 32)
    doubled[at[:-1][at[:-1] < len(data)]] = False
    solid = chars - n[_SPACE] - n[_NEWLINE]

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.divide(part, whole, out=np.zeros(len(chars)), where=whole > 0)

    return np.column_stack([
        np.log1p(chars), np.log1p(words), share(solid, words),
        share(n[_UPPER], n[_UPPER] + n[_LOWER]), share(n[_DIGIT], chars), share(n[_SYMBOL], chars),
        share(n[_SHOUT], chars), share(n[_BAR], chars), share(n[_MARK], chars), share(n[_LEAD], chars),
        share(n[_SPACE] + n[_NEWLINE], chars), share(n[_CONTROL], chars),
        share(_sums(doubled, at), chars), share(distinct, words), share(top, words),
        share(echoes, words), np.log1p(lines[:, 0]), share(lines[:, 1], lines[:, 0]),
        share(lines[:, 2], lines[:, 0]), np.log1p(lines[:, 3]),
    ])


@dataclass
class AdditiveModel:
    """Tables of log odds by bins of features and of pairs of features.

    ``edges[f]`` are the borders between the bins of feature f, ``coarse[f]`` those it has in pairs;
    a value equal to a border belongs to the bin above.
    """

    start: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, rows[:, f], "right")]
        for (a, b), table in self.pairs.items():
            total += table[
                np.searchsorted(self.coarse[a], rows[:, a], "right"),
                np.searchsorted(self.coarse[b], rows[:, b], "right"),
            ]
        return total

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return _share_of(self.log_odds(rows))


def _share_of(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))


def borders(values: np.ndarray, bins: int) -> np.ndarray:
    """Borders of about equally full bins, each a value that occurs."""
    found = np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))
    return found[found > values.min()] if len(values) else found


def shallow_tree(grad: np.ndarray, hess: np.ndarray, depth: int, penalty: float) -> np.ndarray:
    """The step of every bin of one feature, from a tree of at most ``depth`` cuts in a row."""
    whole = grad.sum(), hess.sum()
    if depth and len(grad) > 1:
        left_g, left_h = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1]
        right_g, right_h = whole[0] - left_g, whole[1] - left_h
        gain = left_g ** 2 / (left_h + penalty) + right_g ** 2 / (right_h + penalty)
        cut = int(gain.argmax()) + 1
        if gain[cut - 1] > whole[0] ** 2 / (whole[1] + penalty) + 1e-9:
            return np.r_[
                shallow_tree(grad[:cut], hess[:cut], depth - 1, penalty),
                shallow_tree(grad[cut:], hess[cut:], depth - 1, penalty),
            ]
    return np.full(len(grad), -whole[0] / (whole[1] + penalty))


def crossed_tree(grad: np.ndarray, hess: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """The best tree that cuts both features of a pair once: its gain, and the step of every cell."""
    if min(grad.shape) < 2:
        return 0.0, np.zeros(grad.shape)
    parts = []
    for table in (grad, hess):
        low = table.cumsum(axis=0).cumsum(axis=1)
        top, left, all_ = low[:-1, -1:], low[-1:, :-1], low[-1, -1]
        corner = low[:-1, :-1]
        parts.append(np.stack([corner, top - corner, left - corner, all_ - top - left + corner]))
    gain = (parts[0] ** 2 / (parts[1] + penalty)).sum(axis=0)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    low_low, low_high, high_low, high_high = -parts[0][:, i, j] / (parts[1][:, i, j] + penalty)
    step = np.empty(grad.shape)
    step[:i + 1, :j + 1], step[:i + 1, j + 1:] = low_low, low_high
    step[i + 1:, :j + 1], step[i + 1:, j + 1:] = high_low, high_high
    return float(gain[i, j] - grad.sum() ** 2 / (hess.sum() + penalty)), step


def fit(
    rows: np.ndarray, labels: np.ndarray, bins: int = 48, pair_bins: int = 12, rounds: int = 80, depth: int = 2,
    most_pairs: int = 8, pair_rounds: int = 30, rate: float = 0.2, penalty: float = 1.0,
) -> AdditiveModel:
    """A model of 0/1 ``labels``. Without rows all scores are a half; with one label, near it."""
    n, width = rows.shape
    share = (labels.sum() + 0.5) / (n + 1)
    edges = [borders(rows[:, f], bins) if n else np.zeros(0) for f in range(width)]
    coarse = [borders(rows[:, f], pair_bins) if n else np.zeros(0) for f in range(width)]
    model = AdditiveModel(
        float(np.log(share / (1 - share))), edges, [np.zeros(len(e) + 1) for e in edges], coarse
    )
    if not n or labels.min() == labels.max():
        return model
    place = [np.searchsorted(e, rows[:, f], "right") for f, e in enumerate(edges)]
    odds = np.full(n, model.start)

    def left(cells: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        found = _share_of(odds)
        return (np.bincount(cells, found - labels, size), np.bincount(cells, found * (1 - found), size))

    for _ in range(rounds):
        for f, table in enumerate(model.tables):
            step = rate * shallow_tree(*left(place[f], len(table)), depth, penalty)
            table += step
            odds += step[place[f]]
    cell, shape = {}, {}
    for a, b in combinations(range(width), 2):
        shape[a, b] = len(coarse[a]) + 1, len(coarse[b]) + 1
        cell[a, b] = np.searchsorted(coarse[a], rows[:, a], "right") * shape[a, b][1] + np.searchsorted(
            coarse[b], rows[:, b], "right"
        )

    def crossed(pair: tuple[int, int]) -> tuple[float, np.ndarray]:
        grad, hess = left(cell[pair], shape[pair][0] * shape[pair][1])
        return crossed_tree(grad.reshape(shape[pair]), hess.reshape(shape[pair]), penalty)

    gains = {pair: crossed(pair)[0] for pair in cell}
    chosen = sorted((pair for pair in gains if gains[pair] > 0), key=lambda pair: -gains[pair])[:most_pairs]
    model.pairs = {pair: np.zeros(shape[pair]) for pair in chosen}
    for _ in range(pair_rounds):
        for pair, table in model.pairs.items():
            step = rate * crossed(pair)[1]
            table += step
            odds += step.ravel()[cell[pair]]
    return model


def _with_features(texts: DataFrame, passed: list[str], extra: T.StructField, compute) -> DataFrame:
    """The columns ``passed`` of ``texts`` and what ``compute`` makes of the features of ``text_``."""
    schema = T.StructType([*(texts.schema[name] for name in passed), extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_"):
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in passed), compute(text_features(batch.column("text_")))],
                names=schema.names,
            )

    return batched(texts.select(*passed, "text_")).mapInArrow(run, schema)


def train(
    docs: DataFrame, labels: DataFrame, learns: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", max_rows: int = MAX_ROWS, **options,
) -> AdditiveModel:
    """A model of ``label_col``, which is 0 or 1, from labelled texts.

    ``learns`` says which rows of ``labels`` may be learned from. Of those, ``max_rows`` are drawn by
    hash of id; only their texts are read into features, and only features come to the driver.
    Null labels and labels of no text are left out; an id with several texts or labels has a row for
    each of them, up to the bound.
    """
    drawn = labels.filter(learns & F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("label_id_"), F.col(label_col).cast("int").alias("label_")
    ).orderBy(F.xxhash64("label_id_"), "label_id_", "label_").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id_"), F.coalesce(F.col(text_col), F.lit("")).alias("text_"))
    # At most ``max_rows`` rows of two numbers.
    known = texts.join(F.broadcast(drawn), F.col("id_") == F.col("label_id_")).select(
        F.xxhash64("id_", "text_").alias("key_"), "label_", "text_"
    )
    rows = _with_features(
        known, ["key_", "label_"], T.StructField("features", T.BinaryType()),
        lambda found: pa.array([row.tobytes() for row in found], pa.binary()),
    ).orderBy("key_", "label_", "features").limit(max_rows).collect()
    found = np.frombuffer(b"".join(row["features"] for row in rows)).reshape(-1, len(FEATURES))
    return fit(found, np.array([row["label_"] for row in rows], float), **options)


def score(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and ``score``, the share of label 1 that the model expects.

    Null texts are scored as empty ones. Equal texts have equal scores. Only the two named columns
    are read; a very long text is one slice.
    """
    texts = docs.select(F.col(id_col).alias("id_"), F.coalesce(F.col(text_col), F.lit("")).alias("text_"))
    return _with_features(
        texts, ["id_"], T.StructField("score", T.DoubleType()), lambda found: pa.array(model.scores(found))
    ).select(F.col("id_").alias(id_col), "score")
