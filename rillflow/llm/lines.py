"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last lines decides where a chunk ends: where it is
smallest among its neighbours. So the same lines part in the same places wherever they
stand, and no chunk inside a text is shorter than two lines. Chunks of several lines that were seen
before, byte for byte, are taken out everywhere but at their first place.

A repeated passage shares its outer chunks with the lines around it, so whole chunks leave its
edges behind. ``dedup_passages`` takes repeated chunks as what is settled and compares, in all
other chunks and across the borders between chunks, every run of a few lines, so that a passage
goes to its very ends, also one that holds no whole chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from rillflow.llm.common import as_row, batched, held, row_columns, slices

#: Half-open ranges of lines, and two independent 64-bit hashes of the joined lines.
CHUNK = T.StructType([
    T.StructField("first_line", T.IntegerType()),
    T.StructField("n_lines", T.IntegerType()),
    T.StructField("h1", T.LongType()),
    T.StructField("h2", T.LongType()),
])


def chunk_ends(hashes: list[int], window: int, reach: int, most: int) -> list[int]:
    """Line numbers after which chunks end.

    A chunk ends after a line where the rolling hash of the last ``window`` lines (fewer at
    the start of a text) is smaller than at the ``reach`` lines before and not larger than
    at the ``reach`` lines after, so ends are more than ``reach`` lines apart. Where that
    would leave more than ``most`` lines, it ends after the line of the smallest rolling
    hash among them, which depends on content as well.
    """
    n = len(hashes)
    if not n:
        return []
    line = np.array(hashes, np.uint64)
    rolling = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for back in range(window):
            if back < n:
                rolling[back:] += line[:n - back] * np.uint64((2 * back + 3) ** 7 | 1)
        rolling ^= rolling >> np.uint64(32)
    low = np.ones(n, bool)
    low[:reach] = False
    for step in range(1, reach + 1):
        low[step:] &= rolling[step:] < rolling[:n - step]
        low[:n - step] &= rolling[:n - step] <= rolling[step:]
    cuts = (np.flatnonzero(low) + 1).tolist()
    if not cuts or cuts[-1] != n:
        cuts.append(n)
    ends, start = [], 0
    for cut in cuts:
        while cut - start > most:
            start += int(np.argmin(rolling[start:start + most])) + 1
            ends.append(start)
        ends.append(cut)
        start = cut
    return ends


def _chunks_of(lines: list[bytes], window: int, reach: int, most: int):
    hashes = [xxhash.xxh64_intdigest(line) for line in lines]
    start = 0
    for end in chunk_ends(hashes, window, reach, most):
        yield start, end
        start = end


def _solid_chunks(lines: list[bytes], window: int, reach: int, most: int, min_lines: int):
    """The chunks that have ``min_lines`` lines with something in them."""
    for start, end in _chunks_of(lines, window, reach, most):
        if sum(1 for line in lines[start:end] if line.strip()) >= min_lines:
            yield start, end


def _solid_runs(solid: list[int], min_lines: int):
    """Every run from a line with something in it to the last of ``min_lines`` such lines."""
    for first, last in zip(solid, solid[min_lines - 1:]):
        yield first, last + 1


def _chunks_and_runs(lines: list[bytes], window: int, reach: int, most: int, min_lines: int):
    """Chunks as (first, end, runs inside), and one (0, 0, runs) with the runs across borders.

    A chunk goes from its first to its last line with something in it; without ``min_lines``
    such lines it can't repeat by itself, and its runs count as those across borders.
    """
    solid = [at for at, line in enumerate(lines) if line.strip()]
    runs, found, across, at, place = list(_solid_runs(solid, min_lines)), [], [], 0, 0
    for start, end in _chunks_of(lines, window, reach, most):
        first = place
        while place < len(solid) and solid[place] < end:
            place += 1
        inside = []
        while at < len(runs) and runs[at][0] < end:
            (inside if runs[at][1] <= end else across).append(runs[at])
            at += 1
        if place - first >= min_lines:
            found.append((solid[first], solid[place - 1] + 1, inside))
        else:
            across += inside
    if across:
        found.append((0, 0, across))
    return found


def _range_hashes(lines: list[bytes], start: int, end: int) -> dict:
    joined = b"\n".join(lines[start:end])
    return {
        "first_line": start, "n_lines": end - start,
        "h1": _signed(xxhash.xxh64_intdigest(joined, 1)), "h2": _signed(xxhash.xxh64_intdigest(joined, 2)),
    }


def _per_text(docs: DataFrame, id_col: str, text_col: str, kind: T.DataType, parts: Callable) -> DataFrame:
    """Rows (id_, text_hash_, chunks): a list of ``kind``, what ``parts`` makes of the lines of a text."""
    schema = T.StructType([
        T.StructField("id_", docs.schema[id_col].dataType),
        T.StructField("text_hash_", T.LongType()),
        T.StructField("chunks", T.ArrayType(kind)),
    ])
    chunks = to_arrow_type(T.ArrayType(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_"):
            found = [
                parts(text.encode().split(b"\n")) if text else [] for text in batch.column("text_").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id_"), batch.column("text_hash_"), pa.array(found, chunks)], names=schema.names
            )

    return batched(docs.select(
        F.col(id_col).alias("id_"), F.xxhash64(text_col).alias("text_hash_"),
        F.col(text_col).alias("text_"),
    )).mapInArrow(run, schema)


def _signed(number: int) -> int:
    return number - (1 << 64) if number >= 1 << 63 else number


def _more_than_once(places: DataFrame, name: str) -> DataFrame:
    """Hashes that occur more than once, with their first place.

    Held, so that Spark deals both sides of a join to them anew and can split the rows of a
    range that a large part of the texts share.
    """
    return held(places.groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.min(F.struct("id_", "text_hash_", "first_line")).alias("first")
    ).filter("n > 1").drop("n"), name)


def likely_chunks(found: DataFrame) -> DataFrame:
    """Places (id_, text_hash_, h1, h2, first_line, n_lines) of chunks whose hashes occur twice."""
    places = found.select("id_", "text_hash_", F.explode("chunks").alias("c")).select(
        "id_", "text_hash_", "c.*"
    )
    twice = _more_than_once(places, "twice")
    return held(places.join(twice.drop("first"), ["h1", "h2"]), "likely")


def likely_passages(found: DataFrame) -> DataFrame:
    """The same for chunks, and for the runs that lie in no chunk with an earlier place.

    Runs inside a chunk with an earlier place go with it, and occur at that place as well, so
    only the others are looked for.
    """
    parts = found.select("id_", "text_hash_", F.explode("chunks").alias("c")).select(
        "id_", "text_hash_", "c.chunk.*", "c.runs"
    )
    chunks = _more_than_once(parts.drop("runs").filter("n_lines > 0"), "twice")
    marked = parts.join(chunks, ["h1", "h2"], "left")
    place = F.struct("id_", "text_hash_", "first_line")
    settled = F.col("first").isNotNull() & (place != F.col("first"))
    runs = held(
        marked.filter(~settled).select("id_", "text_hash_", F.explode("runs").alias("r"))
        .select("id_", "text_hash_", "r.*"), "runs",
    )
    names = ["id_", "text_hash_", "h1", "h2", "first_line", "n_lines"]
    repeated = runs.join(_more_than_once(runs, "twice").drop("first"), ["h1", "h2"])
    return held(
        marked.filter(F.col("first").isNotNull()).select(*names).unionByName(repeated.select(*names)), "likely"
    )


def proven_repeats(docs: DataFrame, likely: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id_, text_hash_, gone): the line ranges of repeats, for texts that have any.

    Only the bytes of ``likely`` ranges are shuffled. These are grouped by the bytes themselves:
    each task brings equal ranges down to one row before the shuffle, however many texts share
    them. A range is a repeat if the group of its hashes holds one byte sequence only and it
    isn't its first place.
    """
    lists = likely.groupBy("id_", "text_hash_").agg(
        F.collect_set(F.struct("h1", "h2", "first_line", "n_lines")).alias("likely")
    )
    texts = docs.select(
        F.col(id_col).alias("doc_"), F.xxhash64(text_col).alias("doc_hash_"),
        F.col(text_col).alias("text_"),
    )
    pieces = texts.join(
        lists, F.col("doc_").eqNullSafe(F.col("id_")) & (F.col("doc_hash_") == F.col("text_hash_"))
    ).select("id_", "text_hash_", F.explode(_with_text(F.col("text_"), F.col("likely"))).alias("c"))
    by_bytes = pieces.select("id_", "text_hash_", "c.*").groupBy("h1", "h2", "bytes").agg(
        F.min(F.struct("id_", "text_hash_", "first_line")).alias("first")
    )
    proven = held(by_bytes.groupBy("h1", "h2").agg(
        F.count("*").alias("variants"), F.min("first").alias("first")
    ).filter("variants = 1").select("h1", "h2", "first"), "proven")
    return likely.join(proven, ["h1", "h2"]).filter(
        F.struct("id_", "text_hash_", "first_line") != F.col("first")
    ).groupBy("id_", "text_hash_").agg(
        F.collect_set(F.struct("first_line", "n_lines")).alias("gone")
    )


def _with_text(text, likely):
    """The chunks of a text with their lines, joined again, as ``bytes``."""
    return F.transform(
        F.array(F.split(text, "\n")),
        lambda lines: F.transform(likely, lambda c: F.struct(
            c["h1"].alias("h1"), c["h2"].alias("h2"), c["first_line"].alias("first_line"),
            F.array_join(F.slice(lines, c["first_line"] + 1, c["n_lines"]), "\n").alias("bytes"),
        )),
    )[0]


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2,
    reach: int = 1, most: int = 24, min_lines: int = 2,
) -> DataFrame:
    """``docs`` with ``clean_text``, ``n_lines`` and ``n_removed_lines``.

    Chunks of at least ``min_lines`` lines with something in them that occur more than once
    in all texts, inside one text or in several, stay at their first place only (smallest
    id, then line) and are removed elsewhere. Two chunks are the same if their bytes are.

    Null texts stay null with no lines; an empty text is one empty line. Rows equal in id
    and text count as one and come out alike; rows of null id are told apart by their text.
    Input columns of the three names are replaced, others pass through; no row is dropped.
    """
    def parts(lines: list[bytes]) -> list[dict]:
        return [_range_hashes(lines, *at) for at in _solid_chunks(lines, window, reach, most, min_lines)]

    found = held(_per_text(docs, id_col, text_col, CHUNK, parts).filter(F.size("chunks") > 0), "chunks")
    return _without(docs, proven_repeats(docs, likely_chunks(found), id_col, text_col), id_col, text_col)


def dedup_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2,
    reach: int = 1, most: int = 24, min_lines: int = 2,
) -> DataFrame:
    """``docs`` with ``clean_text``, ``n_lines`` and ``n_removed_lines``; repeated passages go whole.

    Chunks of at least ``min_lines`` lines with something in them go wherever they have an earlier
    place (smaller id, then line), in one text or in several. In what is left, and across borders
    of chunks, a run is ``min_lines`` lines with something in them that follow each other, and the
    blank lines between them; every run with an earlier place goes, too. Runs overlap, so of a
    repeated passage every line goes, wherever it stands. A line goes only if it has an earlier
    copy, so each distinct line stays somewhere. Chunks and runs are the same if their bytes are.
    Blank lines around them stay, unless nothing else of the text does.

    Null, empty and repeated texts and clashing names: as in :func:`dedup_lines`.
    """
    def parts(lines: list[bytes]) -> list[dict]:
        return [
            {"chunk": _range_hashes(lines, start, end), "runs": [_range_hashes(lines, *at) for at in runs]}
            for start, end, runs in _chunks_and_runs(lines, window, reach, most, min_lines)
        ]

    kind = T.StructType([T.StructField("chunk", CHUNK), T.StructField("runs", T.ArrayType(CHUNK))])
    found = held(_per_text(docs, id_col, text_col, kind, parts).filter(F.size("chunks") > 0), "chunks")
    gone = proven_repeats(docs, likely_passages(found), id_col, text_col)
    cleaned = _without(docs, gone, id_col, text_col)
    blank = (F.col("n_removed_lines") > 0) & ~F.col("clean_text").rlike(r"\S")
    return cleaned.withColumns({
        "clean_text": F.when(blank, F.lit("")).otherwise(F.col("clean_text")),
        "n_removed_lines": F.when(blank, F.col("n_lines")).otherwise(F.col("n_removed_lines")),
    })


def _without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the lines that are ``gone``."""
    texts = as_row(docs, "clean_text", "n_lines", "n_removed_lines")
    text = F.col("row_").getField(text_col)
    joined = texts.withColumn("doc_hash_", F.xxhash64(text)).join(
        gone, F.col("row_").getField(id_col).eqNullSafe(F.col("id_"))
        & (F.col("doc_hash_") == F.col("text_hash_")), "left",
    )
    lost = F.coalesce(F.array_distinct(F.flatten(F.transform("gone", lambda r: F.sequence(
        r["first_line"], r["first_line"] + r["n_lines"] - 1
    )))), F.array().cast("array<int>"))
    left = F.transform(F.array(F.split(text, "\n")), lambda lines: F.array_join(
        F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost),
            lambda at: F.get(lines, at),
        ), "\n",
    ))[0]
    n_lines = F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n")))
    return joined.select(
        *row_columns(joined),
        F.when(F.col("gone").isNull(), text).otherwise(left).alias("clean_text"),
        n_lines.cast("long").alias("n_lines"), F.size(lost).cast("long").alias("n_removed_lines"),
    )
