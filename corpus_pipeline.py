"""The corpus pipeline: five stages over documents, each by one operator of rillflow.llm.

A stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import bpe, jaccard, languages, lines, mixing
from rillflow.llm.common import held

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Texts further than this from those of all learned languages, in deviations, are in none of them.
#: Clean held-out texts of the given tables lie above -7; dumps of digits and letters reach from -8
#: down, foreign languages from -20.
LEAST_TYPICAL = -8.0
LEVELS = ["lang", "source"]
#: English and German get twice the share of the others.
WEIGHTS = {("en",): 2.0, ("de",): 2.0}
SHARE, EPOCHS, SEED = 0.9, 2, 17


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts get the language found in them; those in no learned language go.

    These are null texts, texts without a letter, and texts whose trigrams are not those of any
    learned language (``LEAST_TYPICAL``). Short texts stay unless they are far off, very long ones
    are read whole, and repeated rows are treated alike. Ids, sources and labels may be null. If no
    row has a label, or there are no rows, nothing can be told and nothing stays. Columns beyond
    those of documents are dropped, here and in all stages.
    """
    machines = languages.train(docs, F.lit(True), "doc_id", "text", "lang")
    found = languages.identify(docs.select(COLUMNS), machines, keep=tuple(COLUMNS), typicality=True)
    return found.filter(
        (F.col("lang_pred") != languages.UNDETERMINED) & (F.col("typicality") >= LEAST_TYPICAL)
    ).withColumn("lang", F.col("lang_pred")).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of lines are taken out; texts of which nothing is left go.

    Null and empty texts have no repeats and stay. Rows equal in id and text are treated alike; of
    equal passages the one at the smallest id stays (null ids first). No rows: none.
    """
    clean = lines.dedup_passages(docs.select(COLUMNS))
    left = (F.col("n_removed_lines") == 0) | F.col("clean_text").rlike(r"\S")
    return clean.filter(left).select(
        "doc_id", F.col("clean_text").alias("text"), "lang", "source",
        F.length("clean_text").cast("long").alias("n_chars"),
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, similarity 0.8).

    It is the one of the smallest id; rows that share this id, and rows of null id in a group
    without any, stay together. Texts without words are in no group and stay. No rows: none.
    """
    return jaccard.one_per_component(docs.select(COLUMNS), words=5, num=80, den=100)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to target weights: documents come as often as their leaf's epochs say.

    A null language or source is a leaf of its own. Null and empty texts cost nothing; a leaf of
    nothing else stays whole. Rows equal in id and text come together or not at all. No rows: none.
    """
    mixed = mixing.mix(docs.select(COLUMNS), LEVELS, WEIGHTS, SHARE, EPOCHS, SEED)
    return mixed.filter("mix_copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))
    ).select(COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and the digest of the bytes they decode to.

    Null and empty texts have no ids; equal texts have equal ones. One row per row given.
    """
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(
        docs, path, public_tokenizers.PATTERN, keep=("lang", "source", "n_chars"), with_decoded=True
    ).select(
        "doc_id", "lang", "source", "n_chars", "n_tokens",
        F.base64("tokens").alias("tokens_base64"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("encoding", encoding),
]

#: Linear machines, chunk hashes and components are beyond SQL; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents; what a stage returns is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = held(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
