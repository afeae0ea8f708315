"""Token counts of a merge vocabulary by rank-synchronous merging of ragged arrays.

All new pre-tokens of a slice of texts lie in one flat array of symbols. Each step finds
every sequence's lowest-rank pair and merges it, in all sequences at once, until no pair
of any sequence is a piece. The symbols that survive are counted.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rillflow.llm.common import batched, slices, text_parts

SPACE = "▁"
NO_RANK = np.int64(1) << 60
#: Sequences above so many symbols are merged one by one with a heap, in n log n steps.
LONG_SEQUENCE = 2048
#: Pre-tokens whose counts a worker keeps; a full table is emptied.
KEPT_COUNTS = 300_000

_PRE_TOKEN = re.compile(" *[^ ]+| +")


class PieceCounter:
    """Counts what a sentencepiece merge model with byte fallback makes of a text."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        ids = [
            i for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        scores = {model.id_to_piece(i): model.get_score(i) for i in ids}
        # A symbol is a piece, a character of a piece, or one of four kinds of unknown
        # characters by their number of UTF-8 bytes, each of which becomes a token.
        names = list(scores)
        names += sorted({char for name in names for char in name} - set(names))
        at = {name: i for i, name in enumerate(names)}
        unknown = len(names)
        self.size = np.int64(unknown + 4)
        self.cost = np.array(
            [1 if name in scores else len(name.encode()) for name in names] + [1, 2, 3, 4],
            np.int64,
        )
        self.of_char = np.full(0x110000, unknown + 3, np.int32)
        self.of_char[:0x10000] = unknown + 2
        self.of_char[:0x800] = unknown + 1
        self.of_char[:0x80] = unknown
        for name, i in at.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        order = {score: i for i, score in enumerate(sorted(set(scores.values()), reverse=True))}
        merges, beside = {}, set()
        for name, score in scores.items():
            for cut in range(1, len(name)):
                beside.add(at[name[cut - 1]] * int(self.size) + at[name[cut]])
                left, right = at.get(name[:cut]), at.get(name[cut:])
                if left is not None and right is not None:
                    merges[left * int(self.size) + right] = (order[score], at[name])
        self.keys = np.array(sorted(merges), np.int64)
        self.ranks = np.array([merges[key][0] for key in self.keys.tolist()], np.int64)
        self.merged = np.array([merges[key][1] for key in self.keys.tolist()], np.int64)
        self.beside = np.array(sorted(beside), np.int64)
        self.kept: dict[str, int] = {}

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NO_RANK where a pair is no piece."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return np.where(hit, self.ranks[at], NO_RANK), self.merged[at]

    def counts(self, pre_tokens: list[str]) -> np.ndarray:
        """Surviving tokens of each pre-token, which starts with its space."""
        sizes = np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens))
        codes = np.frombuffer("".join(pre_tokens).encode("utf-32-le"), np.uint32)
        symbols = self.of_char[codes].astype(np.int64)
        owner = np.repeat(np.arange(len(pre_tokens)), sizes)
        # Two characters that no piece has side by side never meet: sequences part there.
        keys = symbols[:-1] * self.size + symbols[1:]
        at = np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)
        new = np.ones(len(symbols), bool)
        new[1:] = (self.beside[at] != keys) | (owner[1:] != owner[:-1])
        sequence = np.cumsum(new) - 1
        owner = owner[new]
        tokens = np.zeros(len(owner), np.int64)
        lengths = np.bincount(sequence)
        single = (lengths == 1)[sequence]
        tokens[sequence[single]] = self.cost[symbols[single]]
        long = np.flatnonzero(lengths > LONG_SEQUENCE)
        starts = np.searchsorted(sequence, long)
        for s, start in zip(long.tolist(), starts.tolist()):
            tokens[s] = self._one_by_one(symbols[start:start + lengths[s]].tolist())
        rest = ((lengths > 1) & (lengths <= LONG_SEQUENCE))[sequence]
        self._synchronous(symbols[rest], sequence[rest], tokens)
        return np.bincount(owner, tokens, len(pre_tokens)).astype(np.int64)

    def _synchronous(self, symbols: np.ndarray, sequence: np.ndarray, tokens: np.ndarray) -> None:
        """Merge until no sequence has a pair left; adds the survivors to ``tokens``."""
        if not len(symbols):
            return
        ranks = np.full(len(symbols), NO_RANK)
        merged = np.zeros(len(symbols), np.int64)
        inner = np.flatnonzero(sequence[:-1] == sequence[1:])
        ranks[inner], merged[inner] = self._look_up(symbols[inner], symbols[inner + 1])
        while True:
            starts = np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1]])
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NO_RANK
            sizes = np.diff(np.r_[starts, len(sequence)])
            if done.any():
                over = np.repeat(done, sizes)
                np.add.at(tokens, sequence[over], self.cost[symbols[over]])
                keep = ~over
                symbols, sequence = symbols[keep], sequence[keep]
                ranks, merged = ranks[keep], merged[keep]
                sizes, lowest = sizes[~done], lowest[~done]
            if not len(symbols):
                return
            at = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            # Of equal pairs of a sequence the leftmost goes first, as merging it may
            # bring up a pair of better rank next to it.
            at = at[np.r_[True, sequence[at[1:]] != sequence[at[:-1]]]]
            symbols[at] = merged[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            symbols, sequence = symbols[keep], sequence[keep]
            ranks, merged = ranks[keep], merged[keep]
            touched = np.unique(np.r_[at, at[at > 0] - 1])
            ranks[touched] = NO_RANK
            touched = touched[touched < len(symbols) - 1]
            touched = touched[sequence[touched] == sequence[touched + 1]]
            ranks[touched], merged[touched] = self._look_up(symbols[touched], symbols[touched + 1])

    def _one_by_one(self, symbols: list[int]) -> int:
        """The same merges in one long sequence, by a heap of (rank, place)."""
        n, size = len(symbols), int(self.size)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        flat = np.array(symbols, np.int64)
        ranks, merged = self._look_up(flat[:-1], flat[1:])
        heap = [
            (int(ranks[i]), i, symbols[i], symbols[i + 1], int(merged[i]))
            for i in np.flatnonzero(ranks < NO_RANK).tolist()
        ]
        heapq.heapify(heap)

        def push(i: int, j: int) -> None:
            key = symbols[i] * size + symbols[j]
            k = int(np.searchsorted(self.keys, key))
            if k < len(self.keys) and self.keys[k] == key:
                heapq.heappush(
                    heap, (int(self.ranks[k]), i, symbols[i], symbols[j], int(self.merged[k]))
                )

        while heap:
            _, i, left, right, whole = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = whole, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                push(i, after[j])
            if before[i] >= 0:
                push(before[i], i)
        return sum(int(self.cost[symbol]) for symbol in symbols if symbol >= 0)

    def count_texts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; pre-tokens part before runs of spaces."""
        split = []
        for text in texts:
            if not text:
                split.append([])
                continue
            if SPACE in text:
                text = text.replace(SPACE, " ")
            if "  " in text or text[0] == " " or text[-1] == " ":
                split.append([part[1:] for part in _PRE_TOKEN.findall(" " + text)])
            else:
                split.append(text.split(" "))
        if len(self.kept) > KEPT_COUNTS:
            self.kept.clear()
        kept = self.kept
        new = list({part for parts in split for part in parts if part not in kept})
        if new:
            found = self.counts([SPACE + part.replace(" ", SPACE) for part in new])
            kept.update(zip(new, found.tolist()))
        return [sum(map(kept.__getitem__, parts)) for parts in split]


def count_tokens(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes, n_tokens and over_limit.

    Counts are those of the model file's own library with its defaults, without begin and
    end tokens. The file must be readable at ``model_path`` on every executor. Null and
    empty texts have no tokens. Only the two named columns are read; equal rows give equal
    rows. Whole texts are counted: a slice of a batch holds bounded bytes or one text.
    """
    schema = T.StructType([
        docs.schema[id_col],
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in slices(batches, text_col):
            counter = counter or PieceCounter(model_path)
            column = batch.column(text_col)
            _, at = text_parts(column)
            n = np.array(
                counter.count_texts(column.fill_null("").to_pylist()), np.int64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(np.diff(at)), pa.array(n), pa.array(n > limit)],
                names=schema.names,
            )

    return batched(docs.select(id_col, text_col)).mapInArrow(run, schema)
