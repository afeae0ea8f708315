import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from helpers import frame, odd_rows

from rillflow.llm import bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", "  a  b ", "▁▁a ▁", "a\x85b\x1c c　d", "\n\n \t x", "aaaa" * 900, "- " * 50, "----" * 700,
    "汉字漢字 안녕 🎉👩‍👩‍👧 ", " " * 2500 + "x", "<s>a</s><unk><0x0A>", "áé ﬁ Ⅳ ²³ ٣",
    "<|endoftext|> it's they'll",
]


def random_texts(seed, n=400):
    rng, letters = random.Random(seed), "ab  \n\t▁.,!'sé汉😀\x00tdllmrev09"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def encoder():
    return bpe.PrefixEncoder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


def test_counts_are_the_librarys(monkeypatch):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ODD + random_texts(1)
    want = [len(ids) for ids in model.encode(texts)]
    assert token_counts.PieceCounter(PIECES).count_texts(texts) == want
    monkeypatch.setattr(token_counts, "LONG_SEQUENCE", 3)
    assert token_counts.PieceCounter(PIECES).count_texts(texts) == want


def test_count_operator(spark):
    rows = odd_rows()
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = token_counts.count_tokens(frame(spark, rows), PIECES, limit=50)
    want = [
        (r[0], len((r[1] or "").encode()), len(model.encode(r[1] or "")), len(model.encode(r[1] or "")) > 50)
        for r in rows
    ]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(frame(spark, []), PIECES).count() == 0


def test_ids_are_the_librarys(spark, encoder):
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={}
    )
    for text in ODD + random_texts(2):
        packed = encoder.encode_packed(text)
        assert np.frombuffer(packed, "<u4").tolist() == own.encode_ordinary(text)
        assert encoder.decode_packed(packed) == text.encode()
    rows = odd_rows()
    coded = bpe.encode(frame(spark, rows), RANKS, public_tokenizers.PATTERN)
    found = [
        (r["doc_id"], r["n_tokens"], hashlib.sha256(r["tokens"]).hexdigest(), bytes(r["decoded"]))
        for r in bpe.decode(coded, RANKS).collect()
    ]
    want = []
    for r in rows:
        ids = own.encode_ordinary(r[1] or "")
        data = np.array(ids, "<u4").tobytes()
        want.append((r[0], len(ids), hashlib.sha256(data).hexdigest(), (r[1] or "").encode()))
    assert sorted(found, key=repr) == sorted(want, key=repr)
    both = bpe.encode(frame(spark, rows), RANKS, public_tokenizers.PATTERN, with_decoded=True)
    assert sorted((
        (r["doc_id"], r["n_tokens"], hashlib.sha256(r["tokens"]).hexdigest(), bytes(r["decoded"]))
        for r in both.collect()
    ), key=repr) == sorted(want, key=repr)
    with pytest.raises(ValueError):
        bpe.encode(frame(spark, rows), RANKS, public_tokenizers.PATTERN, keep=("tokens",))
    assert bpe.decode(bpe.encode(frame(spark, []), RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_appends_and_edits(encoder):
    rng = random.Random(3)
    table = bpe.PrefixTable(encoder)
    data = b""
    for _ in range(120):
        more = bytes(rng.choice(b"theand ing\xc3\xa9-") for _ in range(rng.randrange(9)))
        if rng.random() < 0.5 or len(data) < 40:
            table.append(more)
            data += more
        else:
            start = rng.randrange(len(data))
            end = min(len(data), start + rng.randrange(6))
            table.replace(start, end, more)
            data = data[:start] + more + data[end:]
        fresh = bpe.PrefixTable(encoder, data)
        assert (table.data, table.last, table.sizes) == (data, fresh.last, fresh.sizes)
        assert table.ids() == encoder.merged(data)


def test_edit_looks_at_its_surroundings_only(encoder):
    table = bpe.PrefixTable(encoder, b" the quick brown fox" * 400)
    assert table.replace(100, 105, b"slow") < 2 * encoder.longest + 40
    assert table.ids() == bpe.PrefixTable(encoder, table.data).ids()
