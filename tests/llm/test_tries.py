import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rillflow.llm import tries

TURNS = "conv_id long, turn long, role string, text string, depth string, x string, id_ string, n string"


def rebuilt(rows):
    """The conversations, each with the first turns of its group's first one."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in own.items()}
    found = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        found[conv] = own.get(conv - conv % 100, [])[:h] + turns[h:]
    return found


def trie(convs):
    """All nodes by brute force: a walk over every prefix of every conversation."""
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
            if d:
                children[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs_in in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs_in) - 1) * (len(node[-1][1]) if node else 0)
    return sorted((
        min(convs_in), len(node), min(members[node[:-1]]) if node else None, len(convs_in),
        len(children[node]) if node in children else 0, leaves[node], saved[node],
        hashlib.sha256(",".join(
            str(conv) for conv in sorted(convs_in) if len(convs[conv]) == len(node)
        ).encode()).hexdigest(),
    ) for node, convs_in in members.items())


def turns_frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "x", "x", "x") for row in rows], TURNS)


def nodes_of(spark, rows, **options):
    marks = tries.turn_marks(turns_frame(spark, rows), "conv_id", "turn", "role", "text")
    found = tries.prefix_trie(*tries.with_lent_heads(marks), **options)
    assert found.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    return sorted(map(tuple, found.collect()))


def random_turns(seed):
    """Copies of a few openings, cut and continued in few and in many ways."""
    rng, rows = random.Random(seed), []
    openings = [[(rng.choice("ua"), f"{i} {d} é漢") for d in range(rng.randrange(1, 9))] for i in range(4)]
    for conv in range(150):
        turns = rng.choice(openings)[:rng.randrange(9)]
        turns = turns + [("u", rng.choice("abc") + str(conv * rng.randrange(2))) for _ in range(rng.randrange(6))]
        rows += [(conv + 50, 10 * n, *turn) for n, turn in enumerate(turns)]
    return rows


ODD = [
    (None, 1, "user", "lost"), (100, None, "user", "first"), (100, 1, None, "second"), (100, 2, "user", None),
    (107, 5, "user", "a"), (107, 5, "user", "a"), (207, 1, "user", "alone"), (-3, 1, "user", "below"),
    (300, 1, "", ""), (301, 1, None, None), (302, 1, "user", "x" * 30000), (303, 1, "user", "x" * 30000),
]


@pytest.mark.parametrize("chunk, most_cells", [(4096, 1 << 24), (2, 1 << 12), (3, 8)])
def test_nodes_are_those_of_a_plain_walk(spark, monkeypatch, chunk, most_cells):
    if most_cells == 8:
        # So few cells that nearly every prefix passes as shared.
        monkeypatch.setattr(tries, "_LEAST_CELLS", 8)
    rows = random_turns(chunk) + ODD
    assert nodes_of(spark, rows, chunk=chunk, most_cells=most_cells) == trie(rebuilt(rows))


def test_group_of_copies_is_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(tries, "PIECE_IDS", 3)
    rows = [(conv, n, "user", f"t{n}") for conv in range(60) for n in range(3)]
    assert nodes_of(spark, rows) == trie(rebuilt(rows))


def test_few_and_no_conversations(spark):
    assert nodes_of(spark, []) == []
    assert nodes_of(spark, [(None, 1, "user", "x")]) == []
    for rows in ([(7, 1, "user", "x")], [(107, n, "user", "x") for n in range(7)]):
        assert nodes_of(spark, rows) == trie(rebuilt(rows))


def test_ranks_within_one_key_over_many_tasks(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(1).alias("k"), (-F.col("id")).alias("v")
    )
    found = tries.ranked(rows, "k", [F.asc("v")])
    hot = [row["place_"] for row in found.filter("k = 1").orderBy("v").collect()]
    assert hot == list(range(1, 4901))
    assert {row["place_"] for row in found.filter("k <> 1").collect()} == {1}


def test_only_possibly_shared_prefixes_are_left_for_grouping(spark):
    rows = [(conv, n, "user", f"{conv if n else ''}t{n}") for conv in range(1, 40) for n in range(6)]
    marks = tries.turn_marks(turns_frame(spark, rows), "conv_id", "turn", "role", "text")
    ids, turns = tries.with_lent_heads(marks)
    found, _ = tries.prefixes_of(ids, turns)
    kinds = tries.screened(found, tries.shared_cells(found, 1 << 16), 1 << 16).collect()
    first = {}
    for row in sorted(kinds, key=lambda row: (row["id_"], row["depth"])):
        if row["depth"] == 0:
            assert row["kind"] == tries.SHARED
        if row["kind"] != tries.SHARED:
            assert (row["id_"] in first) == (row["kind"] == tries.ALONE)
            first.setdefault(row["id_"], row["depth"])
