"""Mixing sources to target weights: budgets go down a tree of domains, languages, sources.

Column expressions only. A node's budget is its parent's, shared by weight. A child cannot
take more than its leaves hold in ``max_epochs`` epochs; what it leaves goes to its siblings
by weight, and only what a whole subtree cannot take goes to the siblings of the ancestor,
because a subtree's capacity is the sum of its leaves'. A leaf's budget is spent on whole
epochs and then on a prefix of one more epoch, whose order is a seeded hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillflow.llm.common import as_row, held, row_columns
from rillflow.llm.quality import words_of

PARTED = "\x1f"
NULL_NAME = "\x00"
#: Leading hex digits of the order key by which the end of a prefix is narrowed down.
DIGITS = (3, 6)


def path_of(levels: list[str], depth: int) -> Column:
    """The names of the first ``depth`` levels as one text; nulls are a name of their own."""
    if not depth:
        return F.lit("")
    return F.concat_ws(PARTED, *[
        F.coalesce(F.col(level).cast("string"), F.lit(NULL_NAME)) for level in levels[:depth]
    ])


def _weight(weights: dict[tuple, float], path: Column) -> Column:
    if not weights:
        return F.lit(1.0)
    known = F.create_map(*[
        F.lit(part) for names, weight in sorted(weights.items(), key=repr)
        for part in (PARTED.join(NULL_NAME if x is None else str(x) for x in names), float(weight))
    ])
    return F.coalesce(F.try_element_at(known, path), F.lit(1.0))


def order_key(seed: int, epoch: Column, doc_id: Column, text_md5: Column) -> Column:
    """Place of a row in an epoch: 32 hex digits, compared as text."""
    return F.md5(F.concat_ws(
        ":", F.lit(str(seed)), epoch.cast("string"),
        F.coalesce(doc_id.cast("string"), F.lit("")), text_md5,
    ))


def shared(children: DataFrame) -> DataFrame:
    """Adds ``budget`` to children with parent, path, capacity, weight and parent_budget.

    A child is full if the level of tokens per weight that fills it is not above what the
    others leave: going up by capacity per weight, the full ones take their capacity and the
    rest share what is left by weight.
    """
    by_fill = W.partitionBy("parent").orderBy("fill", "path")
    up_to = by_fill.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("parent")
    return (
        children.withColumn("fill", F.col("capacity") / F.nullif(F.col("weight"), F.lit(0.0)))
        .withColumn("fill", F.coalesce("fill", F.lit(float("inf"))))
        .withColumn("cap_so_far", F.sum("capacity").over(up_to))
        .withColumn("weight_left", F.sum("weight").over(whole) - F.sum("weight").over(up_to))
        .withColumn("full", (F.col("weight") > 0) & (
            F.col("cap_so_far") + F.col("fill") * F.greatest("weight_left", F.lit(0.0))
            <= F.col("parent_budget") + 1e-6
        ))
        .withColumn("taken", F.sum(F.when(F.col("full"), F.col("capacity"))).over(whole))
        .withColumn("open_weight", F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole))
        .withColumn("budget", F.when(F.col("full"), F.col("capacity").cast("double")).otherwise(
            F.least(F.col("capacity"), F.coalesce(
                (F.col("parent_budget") - F.coalesce("taken", F.lit(0)))
                * F.col("weight") / F.nullif(F.col("open_weight"), F.lit(0.0)), F.lit(0.0)
            ))
        ))
        .drop("fill", "cap_so_far", "weight_left", "full", "taken", "open_weight")
    )


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[tuple, float],
                 share: float, max_epochs: int) -> DataFrame:
    """Leaves (the levels, available) with their ``path`` and ``budget`` of tokens.

    The tables here have one row per node of the tree, whatever the number of documents.
    """
    leaves = leaves.withColumn("capacity", F.col("available") * max_epochs)
    above = leaves.groupBy(F.lit("").alias("path")).agg(
        F.least(F.floor(F.sum("available") * share), F.sum("capacity")).cast("double").alias("budget")
    )
    for depth in range(1, len(levels) + 1):
        nodes = leaves.groupBy(
            path_of(levels, depth - 1).alias("parent"), path_of(levels, depth).alias("path")
        ).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", _weight(weights, F.col("path"))).join(
            above.select(F.col("path").alias("parent"), F.col("budget").alias("parent_budget")),
            "parent",
        )
        above = held(shared(nodes).select("path", "budget"), "budgets")
    return leaves.withColumn("path", path_of(levels, len(levels))).join(above, "path").select(
        "path", "available", F.floor(F.col("budget") + 1e-6).alias("budget")
    )


def _ends(rows: DataFrame, group: Column, digits: int | None) -> DataFrame:
    """For each leaf the first group of its order that doesn't fit whole, and the tokens before.

    Rows are summed by group before they are shuffled; the window runs over the groups.
    """
    summed = rows.groupBy("path", "rest", "before", group.alias("part")).agg(
        F.sum("tokens").alias("part_tokens")
    )
    order = W.partitionBy("path").orderBy("part")
    so_far = F.col("before") + F.sum("part_tokens").over(
        order.rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    summed = summed.withColumn("so_far", so_far)
    if digits is None:
        return summed.filter("so_far <= rest").groupBy("path").agg(F.max("part").alias("cut"))
    return summed.filter("so_far > rest").groupBy("path").agg(
        F.min("part").alias("end"), F.min_by(F.col("so_far") - F.col("part_tokens"), "part")
        .alias("before"), F.first("rest").alias("rest"),
    )


def mix_plan(docs: DataFrame, levels: list[str], weights: dict[tuple, float], share: float,
             max_epochs: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """One row per leaf: path, available, budget, epochs, and the ``cut`` of the last epoch.

    The cut is found in three passes over a held table of counts, narrowing the order by
    leading digits, so that no window holds more than a few thousand groups of a leaf.
    """
    slim = held(docs.select(
        *[F.col(level).alias(f"level{i}") for i, level in enumerate(levels)], path_of(levels, len(levels)).alias("path"), F.col(id_col).alias("id_"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_md5"),
        F.size(words_of(F.col(text_col))).cast("long").alias("tokens"),
    ), "counts")
    levels = [f"level{i}" for i in range(len(levels))]
    leaves = slim.groupBy(*levels).agg(F.sum("tokens").alias("available"))
    plan = held(
        leaf_budgets(leaves, levels, weights, share, max_epochs).select(
            "path", "available", "budget",
            F.coalesce(F.floor(F.col("budget") / F.nullif("available", F.lit(0))), F.lit(0))
            .cast("long").alias("epochs"),
        ).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("available")),
        "leaves",
    )
    rows = slim.join(plan.select("path", "rest", "epochs"), "path").select(
        "path", "rest", "tokens", F.lit(0).cast("long").alias("before"),
        order_key(seed, F.col("epochs"), F.col("id_"), F.col("text_md5")).alias("key"),
    )
    ends = None
    for digits in DIGITS:
        if ends is not None:
            rows = _inside(rows, ends, digits_before)
        ends = held(_ends(rows, F.substring("key", 1, digits), digits), "ends")
        digits_before = digits
    cuts = _ends(_inside(rows, ends, digits_before), F.col("key"), None)
    cuts = ends.select("path", "end").join(cuts, "path", "left").select(
        "path", F.coalesce("cut", "end").alias("cut")
    )
    # A leaf without tokens has no end: all of its order fits, beyond every hexadecimal key.
    whole = F.when(F.col("available") == 0, F.lit("~"))
    return held(plan.join(cuts, "path", "left").withColumn("cut", F.coalesce(whole, "cut")), "plan")


def _inside(rows: DataFrame, ends: DataFrame, digits: int) -> DataFrame:
    """The rows in the groups where the prefixes end, with the tokens before the group."""
    return rows.drop("before", "rest").withColumn("end", F.substring("key", 1, digits)).join(
        ends, ["path", "end"]
    ).drop("end")


def mix(
    docs: DataFrame, levels: list[str], weights: dict[tuple, float], share: float = 0.5,
    max_epochs: int = 4, seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``mix_path``, ``mix_tokens`` and ``mix_copies`` (0: left out).

    Tokens are words. The whole budget is ``share`` of all tokens. ``weights`` maps a tuple
    of names from the root (None for null) to the node's weight among its siblings; 1 where
    nothing is given, 0 for nodes that get nothing. A row of a leaf comes once per whole
    epoch, and once more if it lies in the last epoch's prefix: rows are taken in order as
    long as all of them together fit the rest of the budget.

    Nulls in a level form a node of their own. Null and empty texts have no tokens: they
    come along at no cost where they lie in a prefix. Rows equal in id and text stand at
    the same place and are taken together or not at all. Input columns of the three names
    are replaced; other columns pass through. No table, leaf or epoch need hold rows.
    """
    plan = mix_plan(docs, levels, weights, share, max_epochs, seed, id_col, text_col).select(
        F.col("path").alias("plan_path"), F.col("epochs").alias("epochs_"), F.col("cut").alias("cut_")
    )
    keyed = as_row(
        docs.withColumn("mix_path", path_of(levels, len(levels))), "mix_tokens", "mix_copies"
    ).withColumn("path_", F.col("row_").getField("mix_path"))
    doc_id, text = (F.col("row_").getField(name) for name in (id_col, text_col))
    key = order_key(seed, F.col("epochs_"), doc_id, F.md5(F.coalesce(text, F.lit(""))))
    joined = keyed.join(plan, F.col("path_") == F.col("plan_path"))
    return joined.select(
        *row_columns(joined), F.size(words_of(text)).cast("long").alias("mix_tokens"),
        (F.col("epochs_") + F.coalesce(key <= F.col("cut_"), F.lit(False)).cast("long"))
        .alias("mix_copies"),
    )
