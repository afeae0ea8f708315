import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import WORD, frame, lowered, odd_rows, row
from pyspark.sql import functions as F

from rillflow.llm import hidden_markov, languages
from rillflow.llm.common import crc_remainder, text_parts, word_hashes

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held_out = crc_remainder("doc_id", 4) == 2
    machines = languages.train(docs, ~held_out, "doc_id", "text", "lang")
    found = languages.identify(docs, machines, keep=("lang",)).filter(held_out)
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right[0] > 0.98 and right[1] > 200


def test_languages_of_odd_rows(spark):
    rows = odd_rows() + [row(50, "123 ... 456"), row(51, "漢字"), row(52, "le la les une des " * 9, "fr"),
                         row(53, "der die das und ein " * 9, "de")]
    docs = frame(spark, rows)
    machines = languages.train(docs, F.lit(True), "doc_id", "text", "lang")
    assert machines.languages == ["de", "en", "fr"]
    found = languages.identify(docs, machines).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for number in (3, 4, 5, 50):
        assert (by_id[number]["lang_pred"], by_id[number]["score"]) == ("und", 0.0)
    assert by_id[51]["lang_pred"] != "und"
    assert by_id[52]["lang_pred"] == "fr" and by_id[53]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in found)
    nothing = languages.train(docs, F.lit(False), "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in languages.identify(docs, nothing).collect()} == {"und"}
    assert languages.identify(frame(spark, []), machines).count() == 0


def test_winners_are_those_of_plain_duels():
    """Predictions against duels counted one by one, over trigrams listed one by one."""
    import pyarrow as pa
    rng = np.random.default_rng(7)
    codes = ["en", "de", "nl", "fr", "es", "fi"]
    machines = languages.fit(rng.poisson(2, (90, languages.FEATURES)), codes * 15, codes)
    texts = ["the house", "das Haus am Meer", "ÀÉ ça", "a", "x y z " * 40, "1 2 3 a"]

    def fold(b):
        return b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32

    def margin(names, text):
        weights, bias = machines.duels[names]
        data = [fold(b) for b in text.encode()]
        grams = [
            ((a << 16 | b << 8 | c) * 0x9E3779B1 >> 12) & (languages.FEATURES - 1)
            for a, b, c in zip(data, data[1:], data[2:])
        ]
        return sum(weights[g] for g in grams) / max(len(grams), 1) + bias

    def winner(names, text):
        names = sorted(names)
        wins, sums = Counter(), Counter()
        for one, two in itertools.combinations(names, 2):
            m = margin((one, two), text)
            wins[one if m > 0 else two] += 1
            sums[one] += m
            sums[two] -= m
        return max(names, key=lambda name: (wins[name], sums[name]))

    found, _ = languages.predict_slice(machines, pa.array(texts))
    assert found == [winner(machines.families[winner(machines.families, text)], text) for text in texts]


def test_what_is_no_language_is_not_typical(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    held_out = crc_remainder("doc_id", 4) == 2
    machines = languages.train(docs, ~held_out, "doc_id", "text", "lang")
    clean = languages.identify(docs.filter(held_out), machines, typicality=True).join(labels, "doc_id")
    assert clean.filter("quality = 1 AND typicality < -8").count() == 0
    draw = random.Random(3)
    hexes = "".join(draw.choice("0123456789abcdef") for _ in range(900))
    noise = [
        hexes, " ".join(hexes[i:i + 4] for i in range(0, 900, 4)),
        "".join(draw.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(900)),
        "".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(900)),
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem.",
    ]
    short = ["the house and the river", "Und", "de la", "x"]
    found = languages.identify(
        frame(spark, [row(i, text) for i, text in enumerate(noise + short)]), machines, typicality=True
    ).orderBy("doc_id").collect()
    assert all(r["typicality"] < -8 for r in found[:5]) and all(r["typicality"] > -7 for r in found[5:])
    for name in ("score", "typicality"):
        with pytest.raises(ValueError):
            languages.identify(docs.withColumn(name, F.lit(1)), machines, keep=(name,), typicality=True)


def test_every_language_is_learned(spark):
    """More languages than families are listed for, most with two rows; fewer rows drawn of the large."""
    draw = random.Random(8)
    words = {f"x{i:03}": ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(8)]
             for i in range(120)}
    words["en"], words["de"] = "the and of to in is that it".split(), "der die und das zu ist ein mit".split()
    rows = [row(i, " ".join(draw.choices(words[lang], k=20)) + f" {i}", lang)
            for i, lang in enumerate(list(words) * 2 + ["en"] * 300)]
    docs = frame(spark, rows)
    machines = languages.train(docs, F.lit(True), "doc_id", "text", "lang", most_rows=1220)
    assert machines.languages == sorted(words)
    assert max(map(len, machines.families.values())) <= languages.FAMILY_SIZE
    assert sorted(itertools.chain(*machines.families.values())) == sorted(words)
    asked = frame(spark, [row(i, " ".join(words[lang] * 3)) for i, lang in enumerate(words)])
    found = {r["doc_id"]: r["lang_pred"] for r in languages.identify(asked, machines).collect()}
    assert sum(found[i] == lang for i, lang in enumerate(words)) > 0.9 * len(words)


def test_few_other_languages_are_families_of_their_own():
    assert languages.grouped(["de", "xx", "en", "yy"]) == {
        "only xx": ["xx"], "only yy": ["yy"], "germanic": ["de", "en"],
    }


def test_sparse_and_dense_counts_train_alike():
    dense = np.random.default_rng(4).poisson(0.2, (24, languages.FEATURES))
    sparse = languages.TrigramCounts(
        [np.flatnonzero(x).astype(np.uint16) for x in dense], [x[x > 0].astype(np.uint32) for x in dense]
    )
    labels = ["en", "de", "fr", "xx"] * 6
    one, other = (languages.fit(x, labels, sorted(set(labels))) for x in (dense, sparse))
    assert one.duels.keys() == other.duels.keys() and len(one.duels) == 4
    for names, (weights, bias) in one.duels.items():
        assert np.allclose(weights, other.duels[names][0], atol=1e-3) and abs(bias - other.duels[names][1]) < 1e-3
    assert abs(one.profile.middle - other.profile.middle) < 1e-4


def test_slices_do_not_matter():
    import pyarrow as pa
    machines = languages.fit(
        np.abs(np.random.default_rng(1).normal(size=(30, languages.FEATURES))),
        ["en", "de", "fr"] * 10, ["de", "en", "fr"],
    )
    texts = ["hello world", "", "x", "ü", "bonjour le monde " * 50]
    whole = languages.predict_slice(machines, pa.array(texts))
    for i, text in enumerate(texts):
        one = languages.predict_slice(machines, pa.array([text]))
        assert one[0][0] == whole[0][i] and abs(one[1][0] - whole[1][i]) < 1e-5


def small_model(seed=0, states=3, width=5):
    draw = np.random.default_rng(seed)
    parts = draw.random(states), draw.random((states, states)), draw.random((states, width))
    return hidden_markov.Model(*[x / x.sum(axis=-1, keepdims=True) for x in parts])


def paths(model, sequence):
    for path in itertools.product(range(len(model.start)), repeat=len(sequence)):
        p = model.start[path[0]]
        for a, b in zip(path, path[1:]):
            p *= model.moves[a, b]
        for state, seen in zip(path, sequence):
            p *= model.emits[state, seen]
        yield path, p


def test_forward_and_counts_by_enumeration():
    model, draw = small_model(), np.random.default_rng(9)
    sequences = [draw.integers(0, 5, n) for n in (1, 4, 2, 6, 4)]
    classes, lengths = np.concatenate(sequences), np.array([len(s) for s in sequences])
    whole = [sum(p for _, p in paths(model, s)) for s in sequences]
    assert np.allclose(hidden_markov.log_likelihood(model, classes, lengths), np.log(whole))
    start, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for s, total in zip(sequences, whole):
        for path, p in paths(model, s):
            start[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total
            for state, seen in zip(path, s):
                emits[state, seen] += p / total
    found = hidden_markov.expected_counts(model, classes, lengths)
    for a, b in zip(found, (start, moves, emits)):
        assert np.allclose(a, b, atol=1e-5)


def test_pieces_cover_all():
    lengths = np.array([1, 1023, 1024, 1025, 2048, 5000])
    pieces, first = hidden_markov._pieces(lengths)
    assert pieces.sum() == lengths.sum() and pieces.max() == 1024 and pieces.min() == 1
    assert first.sum() == len(lengths) and list(np.add.reduceat(pieces, np.flatnonzero(first))) == list(lengths)


def test_pieces_count_as_whole_texts(monkeypatch):
    model, draw = small_model(), np.random.default_rng(4)
    lengths = np.array([1, 7, 30, 8, 3, 64, 9, 2])
    classes = draw.integers(0, 5, lengths.sum())
    whole = hidden_markov.expected_counts(model, classes, lengths)
    for size in (1, 2, 8, 63):
        monkeypatch.setattr(hidden_markov, "PIECE", size)
        cut = hidden_markov.expected_counts(model, classes, *hidden_markov._pieces(lengths))
        for one, other in zip(whole, cut):
            assert np.allclose(one, other, rtol=1e-4, atol=1e-4)


def test_parts_pack_and_unpack():
    by_state = np.random.default_rng(2).random((6, 50)) * [[1], [5], [0], [2], [9], [1]]
    parts = hidden_markov.packed_parts(by_state)
    assert np.allclose(hidden_markov.unpacked_parts(parts, 6), by_state / by_state.sum(axis=0), atol=2e-3)
    assert np.allclose(hidden_markov.unpacked_parts(hidden_markov.packed_parts(np.ones((1, 3))), 1), 1)


def plain_states(start, moves, emits, seen):
    """Chance of each state at each place, chance of each move, and the log likelihood."""
    forward = [start * emits[:, seen[0]]]
    for x in seen[1:]:
        forward.append((forward[-1] @ moves) * emits[:, x])
    backward = [np.ones(len(start))]
    for x in seen[:0:-1]:
        backward.insert(0, moves @ (emits[:, x] * backward[0]))
    whole = forward[-1].sum()
    at = np.array(forward) * np.array(backward) / whole
    went = sum((
        f[:, None] * moves * (emits[:, x] * b)[None, :] / whole
        for f, x, b in zip(forward, seen[1:], backward[1:])
    ), np.zeros_like(moves))
    return at, went, math.log10(whole)


def test_scores_are_those_of_a_plain_model(spark):
    """A plain hidden Markov model of words, text by text in dictionaries, gives the same scores."""
    draw = np.random.default_rng(8)
    names = [[f"{t}{i}" for i in range(30)] for t in "abc"]
    texts = [" ".join(draw.choice(names[i % 3], draw.integers(0, 25))) for i in range(60)] + [None, ""]
    docs = frame(spark, [row(i, t) for i, t in enumerate(texts)]).repartition(3)
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    k, rounds = 3, 2
    found = {r["doc_id"]: r["score"] for r in hidden_markov.score_texts(
        docs, crc_remainder("doc_id", 5) == 1, states=k, rounds=rounds).collect()}

    words = sorted({w for t in texts for w in WORD.findall(t or "")})
    data, at = text_parts(pa.array(words))
    tied = dict(zip(words, hidden_markov.classes_of(word_hashes(data, at)[0].view(np.int64)).tolist()))
    tied[None] = hidden_markov.CLASSES
    tokens = [WORD.findall(t or "") + [None] for t in texts]
    model = hidden_markov.first_model(k, 3)
    start, moves, emits = model.start, model.moves, model.emits
    for _ in range(rounds):
        s, m, e = np.full(k, 0.1), np.full((k, k), 0.1), np.full(emits.shape, 0.01)
        for i, text in enumerate(tokens):
            if not out(i):
                seen = [tied[w] for w in text]
                states, went, _ = plain_states(start, moves, emits, seen)
                s, m = s + states[0], m + went
                for x, p in zip(seen, states):
                    e[:, x] += p
        start, moves, emits = (x / x.sum(axis=-1, keepdims=True) for x in (s, m, e))
    counts = {}
    for i, text in enumerate(tokens):
        if not out(i):
            for w, p in zip(text, plain_states(start, moves, emits, [tied[w] for w in text])[0]):
                counts[w] = counts.get(w, 0) + p
    n = sum(c.sum() for c in counts.values())
    usual = sum(counts.values()) / n
    known = sorted(counts, key=str)
    base = np.array([counts[w].sum() + 0.5 for w in known] + [0.5]) / (n + 0.5 * (len(known) + 1))
    share = np.array([(counts[w] + usual) / (counts[w].sum() + 1) for w in known] + [usual])
    by_word = (base[:, None] * share).T
    by_word /= by_word.sum(axis=1, keepdims=True)
    for i, text in enumerate(tokens):
        seen = [known.index(w) if w in counts else len(known) for w in text]
        assert abs(found[i] - plain_states(start, moves, by_word, seen)[2]) < 0.02 * (1 + len(text) / 10)


def test_scores(spark):
    rows = odd_rows() + [row(100 + i, f"w{i % 5} v{i % 3} common words here " * (i % 4)) for i in range(60)]
    docs = frame(spark, rows)
    held_out = crc_remainder("doc_id", 5) == 1
    found = hidden_markov.score_texts(docs, held_out, rounds=2).collect()
    out = lambda r: zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 5 == 1
    tokens = lambda r: WORD.findall(lowered(r[1])) + [None]
    counts = Counter(t for r in rows if not out(r) for t in tokens(r))
    n, v = sum(counts.values()), len(counts)
    want = sorted(((
        r[0], out(r), len(tokens(r)), sum(counts[t] > 0 for t in tokens(r)), n,
        round(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(r)), 6),
    ) for r in rows), key=repr)
    got = sorted(((*r[:5], round(r["base_score"], 6)) for r in found), key=repr)
    assert got == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)
    assert hidden_markov.score_texts(frame(spark, []), held_out).count() == 0
    untrained = hidden_markov.score_texts(docs, F.lit(True), rounds=1).collect()
    assert len(untrained) == len(rows) and all(r["train_tokens"] == 0 for r in untrained)


def test_words_in_states_beat_counting_words(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held_out = crc_remainder("doc_id", 5) == 1
    total = [
        hidden_markov.score_texts(docs, held_out, rounds=n).filter("held_out")
        .agg(F.sum("score"), F.sum("base_score")).first() for n in (0, 3)
    ]
    assert total[1][0] > total[0][0]
    assert total[1][0] > 0.96 * total[1][1]
