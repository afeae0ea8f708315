"""Exact Jaccard join of texts on word n-grams, by groups and a token-group matrix.

Candidates. A pair with similarity t or more and set sizes n and m differs in at most
``(n + m) * (1 - t) / (1 + t)`` n-grams. Each set is dealt by hash into more parts than
that, so two such sets have at least one part in common, and if parts are put in one fixed
order, the first ``most + 1`` parts of both share one. Parts with most n-grams come first,
so a frequent passage alone is no reason to meet. Sets meeting in a part, directly or over
others, form one candidate class; sets of different classes are never similar.

Groups. The sets of a class are dealt into tasks of bounded size. In a task they are put
into groups of similar sets, and the token-group matrix lists for every n-gram the groups
whose union holds it. A set's overlap with a group's union bounds its similarity to every
member; only groups that may qualify, and hold sets not yet known to be connected to it,
are opened and compared exactly. Classes over several tasks are finished by comparing the
sets outside the largest component with all tasks' sets, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.common import (
    as_row,
    batched,
    chained,
    components,
    cut,
    held,
    mixed,
    row_columns,
    slices,
    text_parts,
    tidy,
    word_hashes,
)

#: N-grams that the sets of one task hold together, about; one set may be larger.
TASK_TOKENS = 4_000_000
#: Sets in a group of the token-group matrix.
GROUP_SETS = 32

_SALT = np.uint64(0xA0761D6478BD642F)


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct word n-grams.

    A text with fewer words has one: the whole sequence. No words: none.
    """
    data, at = text_parts(column)
    hashes, counts = word_hashes(data, at)
    ends = np.cumsum(counts)
    n = len(hashes) - words + 1
    grams = chained([hashes[i:i + n] for i in range(words)]) if n > 0 else hashes[:0]
    found = []
    for end, count in zip(ends.tolist(), counts.tolist()):
        if count >= words:
            found.append(np.unique(grams[end - count:end - words + 1]))
        elif count:
            found.append(chained([hashes[i:i + 1] for i in range(end - count, end)]))
        else:
            found.append(hashes[:0])
    return found


def fingerprint(grams: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    with np.errstate(over="ignore"):
        one = mixed(grams).sum(dtype=np.uint64)
        two = mixed(grams ^ _SALT).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def most_apart(n: int, m: int, num: int, den: int) -> int:
    """Most n-grams in only one of two sets of these sizes with similarity num / den."""
    return (den - num) * (n + m) // (den + num)


def _parts_in(grams: np.ndarray, size_class: int, partner: int, num: int, den: int) -> np.ndarray:
    n, top = len(grams), (2 << size_class) - 1
    apart = most_apart(n, partner, num, den)
    if not apart:
        return grams[:0]
    # One more part than the largest pair of the class can differ in, and a tenth to spare.
    parts = most_apart(top, top * den // num, num, den) * 11 // 10 + 1
    part = (grams % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    counts = np.bincount(part, minlength=parts)
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum(mixed(grams[order] ^ _SALT), dtype=np.uint64)]
        ends = np.cumsum(counts)
        content = sums[ends] - sums[ends - counts]
        marks = mixed(
            content + np.arange(parts, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            + np.uint64(size_class + 1)
        )
    return marks[np.lexsort((marks, -counts))[:apart + 1]]


def signatures(grams: np.ndarray, num: int, den: int) -> np.ndarray:
    """Marks of the parts by which a set meets others; equal sets need none.

    A pair meets in the size class (powers of two) of its smaller set, so a set also shows
    up in the class below if partners that small are possible.
    """
    n = len(grams)
    if not n:
        return grams
    own = n.bit_length() - 1
    found = [_parts_in(grams, own, n * den // num, num, den)]
    low = 1 << own
    if own and -(-n * num // den) < low:
        found.append(_parts_in(grams, own - 1, low - 1, num, den))
    return np.concatenate(found)


def linked_labels(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """For each set the position of the first set (in matrix order) it is connected with."""
    m = len(sets)
    labels = np.arange(m)
    if m < 2:
        return labels
    order = sorted(range(m), key=lambda i: sets[i][:4].tolist())
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    at = np.r_[0, np.cumsum(sizes)]
    _, tokens = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    n_tokens = int(tokens.max()) + 1 if len(tokens) else 0
    n_groups = -(-m // GROUP_SETS)
    group_of = np.arange(m) // GROUP_SETS
    # The matrix, kept as the list of groups of each token.
    cells = np.unique(tokens * n_groups + np.repeat(group_of, sizes))
    cell_group = cells % n_groups
    cell_at = np.searchsorted(cells, np.arange(n_tokens + 1) * n_groups)
    marked = np.zeros(n_tokens, bool)
    for q in range(m):
        own = tokens[at[q]:at[q + 1]]
        if not len(own):
            continue
        apart = labels != labels[q]
        if not apart.any():
            if (labels == labels[0]).all():
                break
            continue
        first, count = cell_at[own], cell_at[own + 1] - cell_at[own]
        ends = np.cumsum(count)
        cell = np.repeat(first - ends + count, count) + np.arange(ends[-1])
        overlap = np.bincount(cell_group[cell], minlength=n_groups)
        marked[own] = True
        for group in np.flatnonzero(den * overlap >= num * len(own)).tolist():
            low, high = group * GROUP_SETS, min(m, (group + 1) * GROUP_SETS)
            if not (labels[low:high] != labels[q]).any():
                continue
            hits = np.r_[0, np.cumsum(marked[tokens[at[low]:at[high]]])]
            inside = hits[at[low + 1:high + 1] - at[low]] - hits[at[low:high] - at[low]]
            alike = den * inside >= num * (len(own) + sizes[low:high] - inside)
            alike &= sizes[low:high] > 0
            for label in np.unique(labels[low:high][alike]).tolist():
                if label != labels[q]:
                    one, two = min(label, labels[q]), max(label, labels[q])
                    labels[labels == two] = one
        marked[own] = False
    found = np.empty(m, np.int64)
    found[order] = np.array(order)[labels]
    return found


def _set_name(one: int, two: int) -> str:
    return f"{one % (1 << 64):016x}{two % (1 << 64):016x}"


def _index(docs: DataFrame, words: int, num: int, den: int, marks: bool) -> DataFrame:
    """Of every text the size and fingerprint of its set, or (``marks``) its signatures."""
    fields = [T.StructField("f1", T.LongType())]
    if marks:
        fields.append(T.StructField("marks", T.ArrayType(T.LongType())))
    else:
        fields = [
            docs.schema["id_"], T.StructField("text_hash_", T.LongType()),
            T.StructField("n", T.LongType()), *fields, T.StructField("f2", T.LongType()),
        ]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_"):
            sets = shingle_sets(batch.column("text_"), words)
            prints = [fingerprint(grams) for grams in sets]
            one = pa.array([x for x, _ in prints], pa.int64())
            if marks:
                seen, found = set(), []
                for grams, key in zip(sets, prints):
                    found.append(
                        [] if key in seen else signatures(grams, num, den).astype(np.int64)
                    )
                    seen.add(key)
                columns = [one, pa.array(found, pa.list_(pa.int64()))]
            else:
                columns = [
                    batch.column("id_"), batch.column("text_hash_"),
                    pa.array([len(grams) for grams in sets], pa.int64()), one,
                    pa.array([x for _, x in prints], pa.int64()),
                ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return batched(docs).mapInArrow(run, schema)


def candidate_classes(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Classes of sets that meet in parts: (id, component) of first fingerprint halves.

    Every part's sets are tied to its smallest, which gives the same classes as all pairs
    would, with one edge per set and part.
    """
    marks = _index(docs, words, num, den, True).select("f1", F.explode("marks").alias("mark"))
    # Held, so that Spark deals both sides of the join anew and can split a frequent part.
    shared = held(
        marks.groupBy("mark").agg(F.min("f1").alias("lead"), F.max("f1").alias("last"))
        .filter("lead <> last").select("mark", "lead"), "shared",
    )
    # Both sides grow with the corpus: merged at every size, never broadcast.
    edges = marks.join(shared.hint("merge"), "mark").filter("f1 <> lead").select(
        F.col("f1").alias("a"), F.col("lead").alias("b")
    ).distinct()
    return components(edges)


LABELLED = T.StructType([
    T.StructField("class", T.LongType()),
    T.StructField("part", T.LongType()),
    T.StructField("parts", T.LongType()),
    T.StructField("set", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("grams", T.ArrayType(T.LongType())),
])


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches as one table per run of equal keys."""
    waiting, current = [], None
    for batch in batches:
        columns = [batch.column(key).to_pylist() for key in keys]
        rows = list(zip(*columns))
        start = 0
        while start < len(rows):
            end = start
            while end < len(rows) and rows[end] == rows[start]:
                end += 1
            if current is not None and rows[start] != current:
                yield pa.Table.from_batches(waiting)
                waiting = []
            current = rows[start]
            waiting.append(batch.slice(start, end - start))
            start = end
    if waiting:
        yield pa.Table.from_batches(waiting)


def _label_tasks(texts: DataFrame, words: int, num: int, den: int, tasks: int) -> DataFrame:
    """The sets of each (class, part), labelled inside the part.

    A label is the name of the smallest set connected within the part. Sets of classes in
    several parts keep their n-grams for the comparison between parts. The number of tasks is
    given, because the work grows with n-grams and not with the bytes that Spark would merge
    small partitions by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for table in _runs(batches, ["class", "part"]):
            sets, names = [], []
            for batch in cut(table.to_batches(), "text_"):
                for grams in shingle_sets(batch.column("text_"), words):
                    name = _set_name(*fingerprint(grams))
                    sets.append(grams)
                    names.append(name)
            first = {name: i for i, name in reversed(list(enumerate(names)))}
            keep = sorted(first.values())
            sets, names = [sets[i] for i in keep], [names[i] for i in keep]
            yield _named(table, sets, names, num, den)

    dealt = texts.repartition(tasks, "class", "part").sortWithinPartitions("class", "part")
    return batched(dealt).mapInArrow(run, LABELLED)


def _named(table: pa.Table, sets: list, names: list[str], num: int, den: int) -> pa.RecordBatch:
    labels = linked_labels(sets, num, den)
    smallest: dict[int, str] = {}
    for label, name in zip(labels.tolist(), names):
        smallest[label] = min(smallest.get(label, name), name)
    n, parts = len(names), table.column("parts")[0].as_py()
    return pa.RecordBatch.from_arrays([
        pa.array([table.column("class")[0].as_py()] * n, pa.int64()),
        pa.array([table.column("part")[0].as_py()] * n, pa.int64()),
        pa.array([parts] * n, pa.int64()),
        pa.array(names), pa.array([smallest[label] for label in labels.tolist()]),
        pa.array([s.astype(np.int64) if parts > 1 else None for s in sets], pa.list_(pa.int64())),
    ], names=LABELLED.names)


def _relabel(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) between labels of sets that share a (class, block) and are connected."""
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["class", "block", "other"]):
            grams = [
                np.asarray(x, np.int64).view(np.uint64) for x in table.column("grams").to_pylist()
            ]
            own = table.column("label").to_pylist()
            found = linked_labels(grams, num, den).tolist()
            edges = sorted({(own[i], own[j]) for i, j in enumerate(found) if own[i] != own[j]})
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in edges], pa.string()),
                 pa.array([b for _, b in edges], pa.string())], names=schema.names,
            )

    keys = ["class", "block", "other"]
    return sets.select(*keys, "label", "grams").repartition(*keys).sortWithinPartitions(*keys) \
        .mapInArrow(run, schema)


def _renamed(rows: DataFrame, names: DataFrame) -> DataFrame:
    return rows.join(names, F.col("label") == F.col("id"), "left").withColumn(
        "label", F.coalesce("component", "label")
    ).drop("id", "component")


def _across_parts(many: DataFrame, num: int, den: int, task_tokens: int) -> DataFrame:
    """Names (id, component) that bring together the labels of the parts of a class."""
    size = F.size("grams")
    blocks_of = lambda total: F.ceil(total / task_tokens)
    # One set of every label, block by block: most of a dense class falls together here.
    chosen = many.groupBy("class", "part", "label").agg(
        F.min_by("grams", "set").alias("grams"), F.min("set").alias("set")
    )
    total = chosen.groupBy("class").agg(blocks_of(F.sum(size)).alias("blocks"))
    first = chosen.join(total, "class").withColumn(
        "block", F.pmod(F.xxhash64("set"), F.col("blocks"))
    ).withColumn("other", F.lit(0))
    names = components(_relabel(first, num, den))
    many = held(_renamed(many, names), "many")
    # A link between components has an end outside the largest one of its class.
    counts = many.groupBy("class", "label").agg(F.count("*").alias("sets"))
    largest = counts.groupBy("class").agg(F.max_by("label", F.struct("sets", "label")).alias("top"))
    outside = many.join(largest, "class").filter("label <> top")
    spread = outside.groupBy("class").agg(blocks_of(F.sum(size)).alias("others"))
    asked = outside.join(spread, "class").select(
        "class", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block"),
        F.pmod(F.xxhash64("set"), F.col("others")).cast("int").alias("other"), "label", "grams",
    )
    there = many.join(spread, "class").select(
        "class", F.col("part").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("others").cast("int") - 1)).alias("other"),
        "label", "grams",
    )
    final = components(_relabel(asked.unionByName(there), num, den))
    return names.join(final.withColumnRenamed("component", "last").withColumnRenamed("id", "id2"),
                      F.col("component") == F.col("id2"), "left").select(
        "id", F.coalesce("last", "component").alias("component")
    ).unionByName(final.join(names.select(F.col("id").alias("known")), F.col("id") == F.col("known"),
                             "left_anti"))


def tasks_for(sets: DataFrame, task_tokens: int) -> int:
    """How many tasks to deal the sets to: a quarter of the bound each, and all cores at least."""
    spark = sets.sparkSession
    total = sets.agg(F.sum("n")).first()[0] or 0
    return max(-(-4 * total // task_tokens), int(spark.conf.get("spark.sql.shuffle.partitions")))


def jaccard_components(
    docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
    text_col: str = "text", task_tokens: int = TASK_TOKENS, with_hash: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, n_shingles and component_id.

    ``with_hash`` adds text_hash_, the xxhash64 of the text, which tells apart rows whose
    ids are equal or null.

    Words are lower-cased in A-Z and part at ASCII white space. Two texts link if their sets
    of ``words``-grams have a similarity of num / den or more; ``component_id`` is the
    smallest id reachable by links. All links count: candidates are complete and no class,
    group or partner is capped. N-grams are compared as 64-bit hashes, sets as 128 bits.

    Null, empty and blank texts have no n-grams and link with nothing. Texts with equal sets
    link. Rows of null id take part in links; a component without any id has a null one.
    Equal rows give equal rows. Only the two named columns are read.
    """
    texts = docs.select(
        F.col(id_col).alias("id_"), F.xxhash64(text_col).alias("text_hash_"),
        F.col(text_col).alias("text_"),
    )
    index = held(_index(texts, words, num, den, False), "sets")
    classes = candidate_classes(texts, words, num, den)
    # One text for each distinct set of a class.
    sets = index.filter("n > 0").groupBy("f1", "f2").agg(
        F.min(F.struct("id_", "text_hash_")).alias("doc"), F.max("n").alias("n")
    ).join(classes, F.col("f1") == F.col("id")).select(
        F.col("component").alias("class"), "f1", "n", "doc.*"
    )
    sets = held(sets, "members")
    parts = sets.groupBy("class").agg(F.ceil(F.sum("n") / task_tokens).alias("parts"))
    members = sets.join(parts, "class").select(
        "class", F.pmod(F.xxhash64("f1"), F.col("parts")).alias("part"), "parts",
        F.col("id_").alias("m_id"), F.col("text_hash_").alias("m_hash"),
    )
    wanted = texts.join(
        members.hint("merge"), F.col("id_").eqNullSafe(F.col("m_id")) & (F.col("text_hash_") == F.col("m_hash"))
    ).select("class", "part", "parts", "text_")
    labelled = held(_label_tasks(wanted, words, num, den, tasks_for(sets, task_tokens)), "labelled")
    many = labelled.filter("parts > 1")
    labels = labelled.select("set", "label")
    if not many.isEmpty():
        labels = _renamed(labels, _across_parts(many, num, den, task_tokens))
    name = F.concat(*[F.lower(F.lpad(F.hex(c), 16, "0")) for c in ("f1", "f2")])
    named = index.withColumn("name", name).join(
        labels.withColumnRenamed("set", "name"), "name", "left"
    ).select("id_", "text_hash_", "n", F.coalesce("label", "name").alias("label"))
    named = held(named, "named")
    smallest = held(
        named.filter("n > 0").groupBy("label").agg(F.min("id_").alias("smallest")), "smallest"
    )
    return named.join(smallest, "label", "left").select(
        F.col("id_").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id_")).otherwise(F.col("smallest")).alias("component_id"),
        *(["text_hash_"] if with_hash else []),
    )


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
                      ) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component.

    Rows of null id stay only in components without any id. Equal rows stay together.
    """
    found = jaccard_components(docs, id_col=id_col, text_col=text_col, with_hash=True, **options)
    kept = found.filter(F.col("component_id").eqNullSafe(F.col(id_col))).select(
        F.col(id_col).alias("keep_id_"), F.col("text_hash_").alias("keep_hash_")
    )
    rows = as_row(docs)
    doc_id, text = (F.col("row_").getField(name) for name in (id_col, text_col))
    return rows.join(
        kept, doc_id.eqNullSafe(F.col("keep_id_")) & (F.xxhash64(text) == F.col("keep_hash_")),
        "left_semi",
    ).select(*row_columns(rows))
