"""Byte-level merge encoding by dynamic programming over prefixes, and decoding.

Every prefix of a byte string has exactly one valid last token: the last token of the
prefix's own encoding. It is found from the tokens that end there: the one that may follow
the last token of the prefix before it. A pair of tokens may stand side by side if encoding
their joined bytes gives the pair back. The table of last tokens lets bytes be appended
without looking back, and an edit be followed only until the table agrees with the old one.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rillflow.llm.common import batched, slices

#: Pieces and pairs a worker remembers; of a full table the older half goes.
KEPT_PIECES = 300_000
KEPT_PAIRS = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=1)
def _encoder(ranks_path: str, pattern: str) -> PrefixEncoder:
    """The encoder of a worker process, which keeps what it knows from task to task."""
    return PrefixEncoder(read_ranks(ranks_path), pattern)


@functools.lru_cache(maxsize=1)
def _tokens(ranks_path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(ranks_path).items()}


def _make_room(table: dict, most: int) -> None:
    """Drop the older half of a full table."""
    if len(table) >= most:
        for key in list(itertools.islice(table, most // 2)):
            del table[key]


class PrefixEncoder:
    """Encodes pieces of text by the ranks of a vocabulary that holds all single bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.split = regex.compile(pattern).findall
        # The automaton takes text; a byte stands as the character of the same number.
        self.ending = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.ending.add_word(token.decode("latin-1"), (rank, len(token)))
        self.ending.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}

    def merged(self, data: bytes) -> list[int]:
        """The encoding by its definition: the lowest-rank pair is merged, again and again."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min(
                (self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
            )
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def may_start(self, token: int) -> bool:
        found = self.alone.get(token)
        if found is None:
            found = self.alone[token] = self.merged(self.tokens[token]) == [token]
        return found

    def may_follow(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        found = self.pairs.get(pair)
        if found is None:
            _make_room(self.pairs, KEPT_PAIRS)
            both = self.tokens[left] + self.tokens[right]
            found = self.pairs[pair] = self.merged(both) == [left, right]
        return found

    def fill(self, data: bytes, last: list[int], sizes: list[int], known: int,
             agree: tuple[list[int], int] | None = None) -> int:
        """Fill the table for the prefixes longer than ``known``; returns where it stopped.

        With ``agree`` (an old table and its shift) it stops after ``longest`` prefixes in a
        row whose last tokens equal the old ones.
        """
        first = max(0, known - self.longest + 1)
        may_follow, same, filled = self.may_follow, 0, known
        for end, (token, size) in self.ending.iter(data[first:].decode("latin-1")):
            end += first + 1
            if end <= filled:
                continue
            start = end - size
            if start < 0 or not (may_follow(last[start], token) if start else self.may_start(token)):
                continue
            last[end], sizes[end], filled = token, size, end
            if agree:
                old = end + agree[1]
                same = same + 1 if last[end] == agree[0][old] else 0
                if same >= self.longest:
                    return end
        return filled

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token stays whole, whatever its merges."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        last, sizes = [-1] * (n + 1), [0] * (n + 1)
        self.fill(piece, last, sizes, 0)
        found = []
        while n:
            found.append(last[n])
            n -= sizes[n]
        return found[::-1]

    def encode_packed(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        kept, parts = self.pieces, []
        for piece in self.split(text):
            found = kept.get(piece)
            if found is None:
                found = np.array(self.encode_piece(piece.encode()), "<u4").tobytes()
                if len(piece) <= 64:
                    _make_room(kept, KEPT_PIECES)
                    kept[piece] = found
            parts.append(found)
        return b"".join(parts)

    def decode_packed(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class PrefixTable:
    """The last tokens of all prefixes of one piece, kept for appends and edits."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data = encoder, b""
        self.last, self.sizes = [-1], [0]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; earlier entries stay as they are."""
        known = len(self.data)
        self.data += more
        self.last += [-1] * len(more)
        self.sizes += [0] * len(more)
        self.encoder.fill(self.data, self.last, self.sizes, known)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` for the bytes from ``start`` to ``end``; returns the entries computed.

        Entries up to ``start`` stay. The entries behind the edit are taken over as soon as
        as many in a row as the longest token has bytes agree with the old ones, because an
        entry depends on no earlier ones.
        """
        old_last, old_sizes = self.last, self.sizes
        shift = (end - start) - len(new)
        self.data = self.data[:start] + new + self.data[end:]
        n = len(self.data)
        self.last = old_last[:start + 1] + [-1] * (n - start)
        self.sizes = old_sizes[:start + 1] + [0] * (n - start)
        edited = start + len(new)
        known = self.encoder.fill(self.data[:edited], self.last, self.sizes, start)
        done = self.encoder.fill(self.data, self.last, self.sizes, known, (old_last, shift))
        self.last[done + 1:] = old_last[done + 1 + shift:]
        self.sizes[done + 1:] = old_sizes[done + 1 + shift:]
        return done - start

    def ids(self) -> list[int]:
        n, found = len(self.data), []
        while n:
            found.append(self.last[n])
            n -= self.sizes[n]
        return found[::-1]


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
    text_col: str = "text", keep: tuple[str, ...] = (), with_decoded: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, the columns of ``keep``, n_tokens, and its ids as ``tokens``.

    ``with_decoded`` adds the bytes that the ids decode to, as ``decoded``, in the same pass over
    the texts. Names of results in ``keep`` are an error. ``tokens`` holds the ids as little-endian unsigned 32-bit numbers. Each match of
    ``pattern`` is encoded by itself; no special tokens are added or recognised. Null and
    empty texts have no ids. The file must be readable at ``ranks_path`` on every executor.
    Only the named columns are read; equal rows give equal rows. A very long text is one
    slice; a piece costs steps in proportion to its bytes.
    """
    names = list(dict.fromkeys([id_col, *keep]))
    results = [T.StructField("n_tokens", T.LongType()), T.StructField("tokens", T.BinaryType())]
    if with_decoded:
        results.append(T.StructField("decoded", T.BinaryType()))
    if clash := {field.name for field in results} & set(names):
        raise ValueError(f"names of results can't be kept: {sorted(clash)}")
    schema = T.StructType([docs.schema[name] for name in names] + results)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for batch in slices(batches, text_col):
            found = [
                encoder.encode_packed(text) if text else b""
                for text in batch.column(text_col).to_pylist()
            ]
            columns = [batch.column(name) for name in names]
            columns += [pa.array([len(ids) // 4 for ids in found], pa.int64()), pa.array(found, pa.binary())]
            if with_decoded:
                columns.append(pa.array(map(encoder.decode_packed, found), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return batched(docs.select(*dict.fromkeys([*names, text_col]))).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, tokens_col: str = "tokens") -> DataFrame:
    """``encoded`` with the bytes of its ids as ``decoded`` (null ids: no bytes).

    An input column named ``decoded`` is replaced.
    """
    kept = [field for field in encoded.schema.fields if field.name != "decoded"]
    schema = T.StructType([*kept, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(ranks_path)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, 256)
                at += part.num_rows
                out = [
                    b"".join(map(tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))
                    for ids in part.column(tokens_col).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(field.name) for field in kept] + [pa.array(out, pa.binary())],
                    names=schema.names,
                )

    return batched(encoded).mapInArrow(run, schema)

