"""The pipeline's stages, each against a plain version on its own input."""

import hashlib
import os

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import frame, linked, odd_rows, roots, shingles
from test_lines import plain_runs as plain_lines
from test_mixing import plain as plain_mix

import corpus_pipeline
from rillflow.llm import bpe
from rillflow.llm.common import held

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def as_rows(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    between = [docs]
    for name, stage in corpus_pipeline.STAGES:
        between.append(held(stage(spark, between[-1], SF_DIR), name))
    assert all(df.columns == docs.columns for df in between[1:-1])
    given, spoken, clean, single, mixed = map(as_rows, between[:-1])
    right = {r[0]: r[2] for r in given}
    assert len(spoken) >= len(given) - 2
    assert np.mean([right[r[0]] == r[2] for r in spoken]) > 0.97
    # Lines: what is left of each text; texts of which nothing is left are gone.
    left = {
        (n, text) for n, text, _, lost in plain_lines(spoken) if not lost or text.strip()
    }
    assert {r[:2] for r in clean} == left
    # Near duplicates: the smallest id of each class.
    sets = [shingles(r[1], 5) for r in clean]
    classes = roots(len(clean), linked(sets, 80, 100))
    smallest = {}
    for r, c in zip(clean, classes):
        smallest[c] = min(smallest.get(c, r[0]), r[0])
    assert sorted(r[0] for r in single) == sorted(smallest.values())
    # Mixing: every text as often as its leaf's epochs say.
    copies = plain_mix(
        single, corpus_pipeline.LEVELS, corpus_pipeline.WEIGHTS, corpus_pipeline.SHARE,
        corpus_pipeline.EPOCHS, corpus_pipeline.SEED,
    )
    assert sorted(r[0] for r in mixed) == sorted(n for n, _, times in copies for _ in range(times))
    # Encoding: the ids of another library, and the text again.
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    other = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = {r[0]: r[1] for r in mixed}
    found = between[-1].selectExpr("doc_id", "n_tokens", "unbase64(tokens_base64) AS ids", "decoded_sha256")
    for r in found.collect():
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert ids == other.encode_ordinary(texts[r["doc_id"]]) and len(ids) == r["n_tokens"]
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_rows_pass_all_stages(spark):
    docs = frame(spark, odd_rows())
    for _, stage in corpus_pipeline.STAGES:
        docs = held(stage(spark, docs, SF_DIR), "stage")
    assert docs.count() > 0


def test_stages_of_empty_tables(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0


def test_what_each_stage_does_with_odd_rows(spark):
    docs = frame(spark, odd_rows())
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted((r["doc_id"] for r in df.collect()), key=repr)
    spoken = stages["language_id"](spark, docs, SF_DIR)
    assert spoken.columns == corpus_pipeline.COLUMNS
    assert not {3, 4, 5} & set(ids(spoken)) and {1, 2, 7, 8, 9} <= set(ids(spoken))
    clean = stages["line_dedup"](spark, docs, SF_DIR)
    assert ids(clean) == ids(docs)
    single = stages["near_duplicates"](spark, docs, SF_DIR)
    assert {3, 4, 5, 7} <= set(ids(single)) and not {2, 6, 8} & set(ids(single))
    mixed = stages["source_mixing"](spark, docs, SF_DIR)
    assert set(ids(mixed)) <= set(ids(docs))
    encoded = stages["encoding"](spark, docs, SF_DIR)
    assert ids(encoded) == ids(docs)
    none = [r for r in encoded.collect() if r["doc_id"] in (3, 4)]
    assert [(r["n_tokens"], r["tokens_base64"]) for r in none] == [(0, "")] * 2
