"""Plain versions of what the operators compute, and the odd rows that all of them meet."""

import re
from collections import Counter

from pyspark.sql import types as T

WORD = re.compile("[^\x20\x09-\x0d]+")

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that operators use for what they add.
    T.StructField("n_words", T.StringType()), T.StructField("text_hash_", T.StringType()),
    T.StructField("label", T.StringType()), T.StructField("id_", T.StringType()),
    T.StructField("block", T.StringType()), T.StructField("tokens", T.StringType()),
])

PROSE = (
    "the quick brown fox jumps over the lazy dog and runs away from the old house by the river "
    "where nobody has lived for many long years, as people say in the village on the hill."
)


def row(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, len(text or ""), "x", "x", "x", "x", "x", "x")


def odd_rows():
    """Nulls in every column, empty and blank texts, repeated rows, a very long text."""
    return [
        row(1, PROSE), row(2, PROSE), row(2, PROSE), row(3, None), row(4, ""), row(5, " \n\t "),
        row(None, PROSE), row(None, None), row(6, PROSE + " More.", None, None),
        row(7, "one two", None, "src1"), row(8, "One\tTWO", "fr", None),
        row(9, (PROSE + "\n") * 400), row(10, "é ü 漢字 \x1f\x85 ok"), row(11, "a" * 20000),
        (12, PROSE.upper(), "en", "src0", None, None, None, None, None, None, None),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, words):
    found = WORD.findall(lowered(text))
    if not found:
        return frozenset()
    if len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i:i + words]) for i in range(len(found) - words + 1))


def linked(sets, num, den):
    """Positions of linked sets, by comparing all pairs that share a shingle."""
    holders = {}
    for i, grams in enumerate(sets):
        for gram in grams:
            holders.setdefault(gram, []).append(i)
    for i, grams in enumerate(sets):
        shared = Counter(j for gram in grams for j in holders[gram] if j < i)
        for j, n in shared.items():
            if den * n >= num * (len(grams) + len(sets[j]) - n):
                yield i, j


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
