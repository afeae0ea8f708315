"""A hidden Markov language model over words, trained by Baum-Welch on Spark.

The first rounds tie words: latent states emit classes into which words fall by hash, so
that a round's expected counts are few and the states find what parts the texts. Then the
words are untied: expected counts by (word, state) become a Spark table with a row for each
word of each block, summed by word in one shuffle, so what is learned grows with the corpus
and never passes through the driver. A state emits a word by the smoothed word count times
how much likelier than elsewhere the state is where the word stands; the sum over all words,
known or not, is one in every state. The probability of a text is computed exactly by the
scaled forward recursion over all its tokens.

Texts are packed once into blocks: the distinct word hashes of the block, and the texts as
places in that list. Counts of words are looked up by block and word, so frequent words are
joined once per block and not once per use.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.common import batched, held, slices, text_parts, word_hashes

#: Text bytes in a block, about.
BLOCK_BYTES = 6 << 20
#: Tokens of the sequences that forward and backward passes take at a time, about.
PASS_TOKENS = 300_000
#: Word classes; the end of a text is a class of its own after them.
CLASSES = 4096
STATES = 6
#: Tokens of a piece: longer texts are trained in pieces side by side, which tell each other
#: what crosses their borders.
PIECE = 1024
#: Uses that a word has in advance in every state's usual share.
PRIOR = 1.0
#: The hash that stands for the end of a text.
END = np.uint64(0x454E444F46544558)
SMOOTH = 0.5
#: By how much a state of the first model stays, besides what all moves get.
STAY = 0.994


def packed(docs: DataFrame, id_col: str, text_col: str, held_out: Column) -> DataFrame:
    """Blocks of texts: (block, ids, held_out, lengths, words, tokens)."""
    schema = T.StructType([
        T.StructField("block", T.LongType()),
        T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType)),
        T.StructField("held_out", T.ArrayType(T.BooleanType())),
        T.StructField("lengths", T.BinaryType()),
        T.StructField("words", T.BinaryType()),
        T.StructField("tokens", T.BinaryType()),
    ])

    def pack(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        hashes, counts, ids, out = [], [], [], []
        for batch in parts:
            data, at = text_parts(batch.column("text_"))
            own, n = word_hashes(data, at)
            hashes.append(np.insert(own, np.cumsum(n), END))
            counts.append(n + 1)
            ids += batch.column("id_").to_pylist()
            out += batch.column("held_out").to_pylist()
        words, tokens, uses = np.unique(
            np.concatenate(hashes), return_inverse=True, return_counts=True
        )
        # Frequent words get small places, which compress best.
        order = np.argsort(-uses, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        words, tokens = words[order], place[tokens]
        block = (TaskContext.get().partitionId() << 24) + number
        return pa.RecordBatch.from_arrays([
            pa.array([block], pa.int64()), pa.array([ids], pa.list_(parts[0].column("id_").type)),
            pa.array([out], pa.list_(pa.bool_())),
            pa.array([np.concatenate(counts).astype(np.int64).tobytes()], pa.binary()),
            pa.array([words.tobytes()], pa.binary()),
            pa.array([_squeezed(tokens)], pa.binary()),
        ], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, number = [], 0, 0
        for batch in slices(batches, "text_"):
            waiting.append(batch)
            size += batch.column("text_").nbytes
            if size >= BLOCK_BYTES:
                yield pack(number, waiting)
                waiting, size, number = [], 0, number + 1
        if waiting:
            yield pack(number, waiting)

    return batched(docs.select(
        F.col(id_col).alias("id_"), F.coalesce(F.col(text_col), F.lit("")).alias("text_"),
        held_out.alias("held_out"),
    )).mapInArrow(run, schema)


def _of(row: dict, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(row[name], kind)


def _squeezed(tokens: np.ndarray) -> bytes:
    """Places of words, all first bytes before all second bytes and so on, compressed."""
    planes = tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return len(tokens).to_bytes(8, "little") + pa.compress(
        np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True
    )


def _tokens(row: dict) -> np.ndarray:
    data = row["tokens"]
    n = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<u4").ravel()


def _spans(lengths: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Runs of sequences of about ``PASS_TOKENS`` tokens, and their tokens."""
    ends = np.cumsum(lengths)
    start = done = 0
    while start < len(lengths):
        end = max(start + 1, int(np.searchsorted(ends, done + PASS_TOKENS, "right")))
        yield slice(start, end), slice(done, int(ends[end - 1]))
        start, done = end, int(ends[end - 1])


def block_words(blocks: DataFrame, model: Model) -> DataFrame:
    """Each block's words: (block, place, word, uses, parts), both of training texts.

    ``parts`` holds how the uses fall to the states under ``model``, see ``packed_parts``.
    """
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("place", T.IntegerType()),
        T.StructField("word", T.LongType()), T.StructField("uses", T.LongType()),
        T.StructField("parts", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                words = _of(row, "words", np.int64)
                emits = np.ascontiguousarray(model.emits[:, classes_of(words)])
                tokens, lengths = _training(row)
                by_state = np.zeros((len(model.start), len(words)))
                for some, places in _spans(lengths):
                    by_state += expected_counts(
                        Model(model.start, model.moves, emits), tokens[places], *_pieces(lengths[some])
                    )[2]
                uses = np.bincount(tokens, minlength=len(words))
                parts = packed_parts(by_state)
                for at in range(0, len(words), 50_000):
                    part = slice(at, at + 50_000)
                    n = len(words[part])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(n, row["block"], np.int64)),
                        pa.array(np.arange(at, at + n, dtype=np.int32)),
                        pa.array(words[part]), pa.array(uses[part].astype(np.int64)),
                        pa.array(parts[part]),
                    ], names=schema.names)

    return blocks.select("block", "held_out", "lengths", "words", "tokens").mapInArrow(run, schema)


def _training(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and lengths of a block's training texts."""
    lengths = _of(row, "lengths", np.int64)
    trains = ~np.array(row["held_out"], bool)
    return _tokens(row)[np.repeat(trains, lengths)], lengths[trains]


def bits_of(states: int) -> int:
    """Bits that a state's part has in a packed long; the last state has what is left."""
    return min(12, 60 // max(1, states - 1))


def packed_parts(by_state: np.ndarray) -> np.ndarray:
    """Parts of the states in each column, as whole numbers packed into one long.

    Whole numbers add up alike in any order, so a retried task changes nothing.
    """
    k = len(by_state)
    bits = bits_of(k)
    shares = by_state / np.maximum(by_state.sum(axis=0), 1e-300)
    found = np.zeros(by_state.shape[1], np.int64)
    for state in range(k - 1):
        found |= np.floor(shares[state] * ((1 << bits) - 1)).astype(np.int64) << (bits * state)
    return found


def unpacked_parts(parts: np.ndarray, k: int) -> np.ndarray:
    """Shares of the states, one row each."""
    bits = bits_of(k)
    top = (1 << bits) - 1
    found = np.array([(parts >> (bits * state)) & top for state in range(k - 1)]).reshape(k - 1, len(parts))
    return np.vstack([found, top - found.sum(axis=0)]) / top


def classes_of(words: np.ndarray) -> np.ndarray:
    """The class of each word hash."""
    found = (words.view(np.uint64) % np.uint64(CLASSES)).astype(np.int32)
    found[words.view(np.uint64) == END] = CLASSES
    return found


@dataclass
class Model:
    """Start, moves and emissions of the states; rows sum to one."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray


def first_model(states: int, seed: int) -> Model:
    """States that lean to different classes and last long, so that the first rounds part texts
    and later ones what is within them."""
    draw = np.random.default_rng(seed)
    emits = draw.gamma(0.5, 2.0, (states, CLASSES + 1)) + 1e-3
    moves = np.full((states, states), (1 - STAY) / states) + STAY * np.eye(states)
    return Model(np.full(states, 1 / states), moves, emits / emits.sum(axis=1, keepdims=True))


def _by_length(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences from long to short, their first places, and how many reach each step."""
    order = np.argsort(-lengths, kind="stable")
    starts = np.cumsum(lengths) - lengths
    longest = int(lengths.max()) if len(lengths) else 0
    reach = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), "right")
    return order, starts[order], reach


def log_likelihood(model: Model, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log probability of each class sequence, by the scaled forward recursion."""
    order, starts, reach = _by_length(lengths)
    emits = np.ascontiguousarray(model.emits.T)
    total = np.zeros(len(lengths))
    alpha = np.zeros((0, len(model.start)))
    for step, n in enumerate(reach.tolist()):
        seen = emits[classes[starts[:n] + step]]
        alpha = seen * model.start if step == 0 else (alpha[:n] @ model.moves) * seen
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        total[:n] += np.log(scale)
    found = np.empty(len(lengths))
    found[order] = total
    return found


def _border_messages(model: Model, emits: np.ndarray, classes: np.ndarray, lengths: np.ndarray,
                     first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What pieces of one text tell each other: the states before each piece, given all tokens
    up to there, and how well each state at its end explains all tokens after it.

    Every piece becomes one matrix from the state before it to the state at its end, all
    pieces side by side; vectors then run over the matrices of a text, both ways.
    """
    k = len(model.start)
    before, after = np.full((len(lengths), k), 1 / k), np.ones((len(lengths), k))
    last = np.append(first[1:], True)
    several = np.flatnonzero(~(first & last))
    if not len(several):
        return before, after
    order, _, reach = _by_length(lengths[several])
    at = several[order]
    starts = (np.cumsum(lengths) - lengths)[at]
    whole = np.empty((len(several), k, k))
    for step, n in enumerate(reach.tolist()):
        seen = emits[classes[starts[:n] + step]]
        if step == 0:
            now = np.where(first[at][:, None, None], model.start, model.moves) * seen[:, None, :]
        else:
            if n < len(now):
                whole[n:len(now)] = now[n:]
            now = (now[:n].reshape(-1, k) @ model.moves).reshape(n, k, k) * seen[:, None, :]
        now /= now.sum(axis=(1, 2))[:, None, None]
    whole[:len(now)] = now
    matrix = np.empty_like(whole)
    matrix[order] = whole
    # Pieces by their number in their text; all texts take a step together.
    heads = np.maximum.accumulate(np.where(first[several], np.arange(len(several)), 0))
    number = np.arange(len(several)) - heads
    by_number = np.argsort(number, kind="stable")
    ends = np.cumsum(np.bincount(number))
    groups = np.split(by_number, ends[:-1])
    for group in groups:
        group = group[~last[several[group]]]
        out = np.einsum("ni,nij->nj", before[several[group]], matrix[group])
        before[several[group] + 1] = out / out.sum(axis=1, keepdims=True)
    for group in reversed(groups[1:]):
        back = np.einsum("nij,nj->ni", matrix[group], after[several[group]])
        after[several[group] - 1] = back / back.sum(axis=1, keepdims=True)
    return before, after


def expected_counts(model: Model, classes: np.ndarray, lengths: np.ndarray,
                    first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of all sequences, by forward and backward passes.

    ``first`` marks the pieces that begin a text; the others go on where the piece before
    them ends. Without it every sequence is a text.
    """
    k = len(model.start)
    if first is None:
        first = np.ones(len(lengths), bool)
    order, starts, reach = _by_length(lengths)
    emits = np.ascontiguousarray(model.emits.T)
    before, after = _border_messages(model, emits, classes, lengths, first)
    first, before, after = first[order], before[order], after[order]
    alphas = np.zeros((len(classes), k), np.float32)
    scales = np.ones(len(classes), np.float32)
    alpha = np.zeros((0, k))
    for step, n in enumerate(reach.tolist()):
        at = starts[:n] + step
        seen = emits[classes[at]]
        if step == 0:
            alpha = seen * np.where(first[:, None], model.start, before @ model.moves)
        else:
            alpha = (alpha[:n] @ model.moves) * seen
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        alphas[at] = alpha
        scales[at] = scale
    after /= (alphas[starts + lengths[order] - 1] * after).sum(axis=1, keepdims=True)
    moves = np.zeros((k, k))
    beta = np.ones((0, k))
    for step in range(len(reach) - 1, -1, -1):
        n = int(reach[step])
        at = starts[:n] + step
        now = after[:n].copy()
        if step + 1 < len(reach):
            m = int(reach[step + 1])
            following = at[:m] + 1
            ahead = emits[classes[following]] * beta / scales[following][:, None]
            moves += alphas[at[:m]].T @ ahead
            now[:m] = ahead @ model.moves.T
        beta = now
        alphas[at] *= beta
    if not first.all():
        inner = starts[~first]
        ahead = emits[classes[inner]] * beta[~first] / scales[inner][:, None]
        moves += before[~first].T @ ahead
    moves *= model.moves
    began = alphas[starts[first]].sum(axis=0, dtype=np.float64)
    emitted = np.array([
        np.bincount(classes, alphas[:, state], model.emits.shape[1]) for state in range(k)
    ])
    return began, moves, emitted


def _pieces(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the pieces of texts, and which pieces begin a text."""
    n = -(-lengths // PIECE)
    found = np.full(int(n.sum()), PIECE, np.int64)
    found[np.cumsum(n) - 1] = lengths - (n - 1) * PIECE
    first = np.zeros(len(found), bool)
    first[np.cumsum(n) - n] = True
    return found, first


def baum_welch(blocks: DataFrame, model: Model) -> Model:
    """One round of Baum-Welch over all training texts, words of a class tied."""
    k, width = model.emits.shape
    schema = T.StructType([
        T.StructField("cell", T.IntegerType()), T.StructField("total", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k + k * width)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                tokens, lengths = _training(row)
                classes = classes_of(_of(row, "words", np.int64))[tokens]
                for some, places in _spans(lengths):
                    found = expected_counts(model, classes[places], *_pieces(lengths[some]))
                    total += np.concatenate([part.ravel() for part in found])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=schema.names
        )

    rows = blocks.select("held_out", "lengths", "words", "tokens").mapInArrow(run, schema)
    summed = rows.groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
    total = np.zeros(k + k * k + k * width)
    total[summed.column("cell").to_numpy()] = summed.column("total").to_numpy()
    start, moves = total[:k], total[k:k + k * k].reshape(k, k)
    emits = total[k + k * k:].reshape(k, width)
    # A little of everything, so that no class is impossible in any state.
    start, moves, emits = start + 0.1, moves + 0.1, emits + 0.01
    return Model(
        start / start.sum(), moves / moves.sum(axis=1, keepdims=True),
        emits / emits.sum(axis=1, keepdims=True),
    )


def known_words(uses: DataFrame, states: int) -> DataFrame:
    """Each block's words with the uses and parts in all blocks: (block, place, n, parts, first).

    One shuffle by word. A word has one row per block, however often it is used, so even
    the most frequent one is as many rows as there are blocks; they pass through a sort
    that spills. ``first`` marks one row of each word.
    """
    whole = W.partitionBy("word")
    bits = bits_of(states)
    summed = uses.select(
        "block", "place", F.sum("uses").over(whole).alias("n"),
        (F.col("block") == F.min("block").over(whole)).alias("first"),
        *[F.sum(F.col("uses") * _part("parts", state, bits)).over(whole).alias(f"part_{state}")
          for state in range(states - 1)],
    )
    parts = F.lit(0).cast("long")
    for state in range(states - 1):
        share = F.floor(F.col(f"part_{state}") / F.col("n")).cast("long")
        parts = parts.bitwiseOR(F.shiftleft(share, bits * state))
    return summed.filter("n > 0").select("block", "place", "n", parts.alias("parts"), "first")


def _part(column: str, state: int, bits: int) -> Column:
    return F.shiftrightunsigned(F.col(column), bits * state).bitwiseAND(F.lit((1 << bits) - 1))


@dataclass
class Totals:
    """What the driver knows of the words: their uses, their number, and two shares per state.

    ``usual`` is a state's share of all training tokens, ``mean`` its mean share over the
    smoothed word counts, which makes each state's emissions sum to one.
    """

    uses: float
    distinct: float
    usual: np.ndarray
    mean: np.ndarray


def totals_of(known: DataFrame, states: int) -> Totals:
    """One row from Spark, whatever the number of words."""
    bits = bits_of(states)
    top = float((1 << bits) - 1)
    weight = (F.col("n") + SMOOTH) / (F.col("n") + PRIOR)
    shares = [_part("parts", state, bits) / top for state in range(states - 1)]
    row = known.filter("first").agg(
        F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(weight).alias("w"),
        F.sum(weight * F.col("n")).alias("wn"),
        *[F.sum(F.col("n") * x).alias(f"n_{i}") for i, x in enumerate(shares)],
        *[F.sum(weight * F.col("n") * x).alias(f"w_{i}") for i, x in enumerate(shares)],
    ).first()
    n, v = float(row["n"] or 0), float(row["v"])
    if not n:
        return Totals(0.0, 0.0, np.full(states, 1 / states), np.full(states, 1 / states))
    usual = np.array([row[f"n_{i}"] for i in range(states - 1)]) / n
    usual = np.maximum(np.append(usual, 1 - usual.sum()), 1e-9)
    usual /= usual.sum()
    known_part = np.array([row[f"w_{i}"] for i in range(states - 1)])
    known_part = np.append(known_part, row["wn"] - known_part.sum())
    mean = known_part + usual * (PRIOR * row["w"] + SMOOTH)
    return Totals(n, v, usual, mean / (n + SMOOTH * (v + 1)))


def lean_of(n: np.ndarray, parts: np.ndarray, totals: Totals) -> np.ndarray:
    """By how much each state emits each word more often than all states together do."""
    own = unpacked_parts(parts, len(totals.usual)) * n + PRIOR * totals.usual[:, None]
    return own / (n + PRIOR) / totals.mean[:, None]


def score_texts(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
    states: int = STATES, rounds: int = 3, seed: int = 3,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words, lower-cased in A-Z and parted at ASCII white space, and one end.
    ``base_score`` is the log10 probability under smoothed word counts, ``score`` the one
    under the hidden Markov model; both learn from all rows where ``held_out`` is false.
    ``n_known`` tokens occur in training. The model has ``rounds`` rounds of Baum-Welch with
    tied words and one that unties them.

    Null and empty texts are their end only. Equal rows count as often as they occur and
    come out alike. Words are compared as 64-bit hashes. With nothing to train on, counts
    are zero and the model is uniform. Only the named columns are read.
    """
    blocks = held(packed(docs, id_col, text_col, held_out), "blocks")
    model = first_model(states, seed)
    for _ in range(rounds):
        model = baum_welch(blocks, model)
    known = held(known_words(block_words(blocks, model), states), "known")
    totals = totals_of(known, states)
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("held_out", T.BooleanType()),
        *[T.StructField(x, T.LongType()) for x in ("n_tokens", "n_known", "train_tokens")],
        *[T.StructField(x, T.DoubleType()) for x in ("base_score", "score")],
    ])
    start, moves = model.start, model.moves

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for i in range(left.num_rows):
            ids = left.column("ids").slice(i, 1).combine_chunks().flatten()
            row = left.select(["held_out", "lengths", "words", "tokens"]).slice(i, 1).to_pylist()[0]
            words, tokens = _of(row, "words", np.int64), _tokens(row)
            lengths = _of(row, "lengths", np.int64)
            n, shares = np.zeros(len(words)), np.zeros(len(words), np.int64)
            places = right.column("place").to_numpy()
            n[places] = right.column("n").to_numpy()
            shares[places] = right.column("parts").to_numpy()
            base = np.log10((n + SMOOTH) / (totals.uses + SMOOTH * (totals.distinct + 1)))
            starts = np.cumsum(lengths) - lengths
            sums = [np.add.reduceat(x[tokens], starts) for x in (n > 0, base)] \
                if len(starts) else [np.zeros(0)] * 2
            lean = Model(start, moves, lean_of(n, shares, totals))
            chain = np.concatenate([np.zeros(0), *[
                log_likelihood(lean, tokens[places], lengths[some])
                for some, places in _spans(lengths)
            ]]) / np.log(10)
            parts.append(pa.Table.from_arrays([
                ids, pa.array(row["held_out"], pa.bool_()), pa.array(lengths),
                pa.array(sums[0].astype(np.int64)),
                pa.array(np.full(len(lengths), int(totals.uses), np.int64)),
                pa.array(sums[1]), pa.array(sums[1] + chain),
            ], names=schema.names))
        if not parts:
            return pa.Table.from_pylist([], schema=wanted)
        return pa.concat_tables(parts)

    from pyspark.sql.pandas.types import to_arrow_schema
    wanted = to_arrow_schema(schema)
    sent = known.select("block", "place", "n", "parts")
    return blocks.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(run, schema)
