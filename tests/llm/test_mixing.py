import hashlib
from collections import defaultdict

import pytest
from helpers import WORD, frame, odd_rows, row

from rillflow.llm import mixing


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def shares(nodes, budget):
    """Water filling by rounds: nodes are (name, capacity, weight)."""
    out = {name: 0.0 for name, _, _ in nodes}
    open_, left = [n for n in nodes if n[2] > 0], budget
    while open_:
        total = sum(n[2] for n in open_)
        full = [n for n in open_ if n[1] <= left * n[2] / total + 1e-9]
        if not full:
            for name, _, weight in open_:
                out[name] = left * weight / total
            break
        for name, capacity, _ in full:
            out[name] = float(capacity)
        left -= sum(n[1] for n in full)
        open_ = [n for n in open_ if n not in full]
    return out


def plain(rows, levels, weights, share, epochs, seed):
    names = {"lang": 2, "source": 3}
    leaf = lambda r: tuple(r[names[x]] for x in levels)
    words = lambda r: len(WORD.findall(r[1] or ""))
    have = defaultdict(int)
    for r in rows:
        have[leaf(r)] += words(r)
    budgets = {(): min(int(sum(have.values()) * share), sum(have.values()) * epochs)}
    for depth in range(1, len(levels) + 1):
        below = defaultdict(lambda: defaultdict(int))
        for path, n in have.items():
            below[path[:depth - 1]][path[:depth]] += n * epochs
        for parent, children in below.items():
            budgets |= shares([(c, n, weights.get(c, 1.0)) for c, n in children.items()], budgets[parent])
    out = []
    for path, n in have.items():
        budget = int(budgets[path] + 1e-6)
        whole = budget // n if n else 0
        rest, so_far = budget - whole * n, 0
        own = [r for r in rows if leaf(r) == path]
        key = lambda r, e=whole: md5(f"{seed}:{e}:{'' if r[0] is None else r[0]}:{md5(r[1] or '')}")
        groups = defaultdict(list)
        for r in own:
            groups[key(r)].append(r)
        for k in sorted(groups):
            so_far += sum(map(words, groups[k]))
            out += [(r[0], words(r), whole + (so_far <= rest)) for r in groups[k]]
    return sorted(out, key=repr)


def corpus():
    rows = odd_rows()
    for i in range(400):
        lang, source = "en de fr".split()[i % 7 % 3], f"src{i % 5 if i % 3 else 0}"
        rows.append(row(1000 + i, "word " * (i * 37 % 90), lang, source))
    return rows


@pytest.mark.parametrize("share,epochs", [(0.5, 1), (1.4, 3), (9.0, 2), (0.0, 1)])
def test_copies(spark, share, epochs):
    rows, weights = corpus(), {("en",): 1.0, ("de",): 6.0, ("fr", "src1"): 0.0, ("de", "src0"): 3.0}
    mixed = mixing.mix(frame(spark, rows), ["lang", "source"], weights, share, epochs, 7)
    found = mixed.select("doc_id", "mix_tokens", "mix_copies").collect()
    assert sorted(map(tuple, found), key=repr) == \
        plain(rows, ["lang", "source"], weights, share, epochs, 7)


def test_siblings_before_ancestors(spark):
    rows = [row(i, "w " * 10, "en", "a" if i < 5 else "b") for i in range(60)]
    rows += [row(100 + i, "w " * 10, "de", "c") for i in range(60)]
    mixed = mixing.mix(frame(spark, rows), ["lang", "source"], {}, 0.5, 1, 1)
    taken = {r["lang"]: r["n"] for r in mixed.selectExpr(
        "lang", "mix_tokens * mix_copies AS t").groupBy("lang").agg({"t": "sum"})
        .withColumnRenamed("sum(t)", "n").collect()}
    # Source a is short; its sister source b makes up for it, not the other language.
    assert taken == {"en": 300, "de": 300}


def test_empty_and_native(spark):
    mixed = mixing.mix(frame(spark, []), ["lang", "source"], {}, 0.5, 1, 1)
    assert mixed.count() == 0
    plan = mixing.mix(frame(spark, corpus()), ["lang"], {}, 0.5, 1, 1)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_leaf_without_tokens_comes_along(spark):
    rows = [row(1, None, "xx"), row(2, "", "xx"), row(3, " \n", "xx"), row(4, "a b c", "en"), row(5, "d e", "en")]
    for share in (0.0, 0.5, 1.0):
        mixed = mixing.mix(frame(spark, rows), ["lang"], {}, share, 2, 3)
        found = sorted(((r["doc_id"], r["mix_tokens"], r["mix_copies"]) for r in mixed.collect()), key=repr)
        assert found == plain(rows, ["lang"], {}, share, 2, 3)
        assert [copies for n, _, copies in found if n < 4] == [1, 1, 1]
