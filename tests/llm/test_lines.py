import random

import xxhash
from helpers import frame, odd_rows, row

from rillflow.llm import lines


def plain_chunks(own, window, reach, most):
    """Boundaries by the rule: a line whose rolling hash is the lowest among its neighbours ends a chunk."""
    rolling = []
    for i in range(len(own)):
        total = 0
        for back in range(min(window, i + 1)):
            total += xxhash.xxh64_intdigest(own[i - back]) * ((2 * back + 3) ** 7 | 1)
        total %= 1 << 64
        rolling.append(total ^ total >> 32)
    cuts = [
        i + 1 for i in range(reach, len(own))
        if all(rolling[i] < x for x in rolling[i - reach:i]) and all(rolling[i] <= x for x in rolling[i + 1:i + 1 + reach])
    ]
    start = 0
    for cut in sorted({*cuts, len(own)} - {0}):
        while cut - start > most:
            end = start + rolling.index(min(rolling[start:start + most]), start) - start + 1
            yield start, end
            start = end
        yield start, cut
        start = cut


def plain(rows, window=2, reach=1, most=24, min_lines=2):
    """The same rule with whole chunks in a dictionary; equal rows count as one."""
    chunks = {}
    for r in sorted(set((r[0], r[1]) for r in rows), key=lambda x: (x[0] is not None, x[0] or 0)):
        if r[1]:
            own = r[1].encode().split(b"\n")
            for start, end in plain_chunks(own, window, reach, most):
                if sum(bool(x.strip()) for x in own[start:end]) >= min_lines:
                    chunks.setdefault(b"\n".join(own[start:end]), []).append((r, start, end))
    gone = {}
    for places in chunks.values():
        for r, start, end in places[1:]:
            gone.setdefault(r, set()).update(range(start, end))
    out = []
    for r in rows:
        if r[1] is None:
            out.append((r[0], None, 0, 0))
            continue
        own, lost = r[1].split("\n"), gone.get((r[0], r[1]), set())
        left = "\n".join(x for i, x in enumerate(own) if i not in lost)
        out.append((r[0], left, len(own), len(lost)))
    return sorted(out, key=repr)


def found(spark, rows):
    df = lines.dedup_lines(frame(spark, rows))
    return sorted(
        map(tuple, df.select("doc_id", "clean_text", "n_lines", "n_removed_lines").collect()), key=repr
    )


def test_repeats_go(spark):
    rng = random.Random(5)
    shared = [f"shared line {i} of the passage." for i in range(14)]
    rows = []
    for number in range(100, 140):
        own = [f"line {rng.random()} of its own." for _ in range(rng.randrange(1, 30))]
        at = rng.randrange(len(own) + 1)
        part = shared if number % 3 else shared[:rng.randrange(2, 14)]
        rows.append(row(number, "\n".join(own[:at] + part + own[at:])))
    rows += [row(200, "same\nlines\n" * 40), row(201, None), row(202, ""), row(203, "\n\n\n\n")]
    got = found(spark, rows)
    assert got == plain(rows)
    removed = {r[0]: r[3] for r in got}
    # The passage parts alike wherever it stands: nearly all of it goes, own lines stay.
    assert sum(removed[n] >= 8 for n in range(101, 140) if n % 3) >= 24
    own_left = {r[0]: r[1] for r in got}
    for r in rows[:40]:
        assert [x for x in r[1].split("\n") if "own" in x] == \
            [x for x in own_left[r[0]].split("\n") if "own" in x]


def test_odd_rows(spark):
    rows = [r for r in odd_rows() if r[0] is not None]
    assert found(spark, rows) == plain(rows)
    assert len(found(spark, odd_rows())) == len(odd_rows())
    assert found(spark, []) == []


def test_ends_follow_content():
    rng = random.Random(8)
    hashes = [rng.getrandbits(64) for _ in range(300)]
    ends = lines.chunk_ends(hashes, 2, 1, 24)
    moved = lines.chunk_ends([1, 2, 3, 4, 5] + hashes, 2, 1, 24)
    assert ends[-1] == 300 and max(b - a for a, b in zip([0] + ends, ends)) <= 24
    assert len(set(e + 5 for e in ends) - set(moved)) <= 2
    assert min(b - a for a, b in zip(ends, ends[1:-1])) > 1
    assert lines.chunk_ends([], 2, 1, 24) == []
    assert max(lines.chunk_ends([7] * 100, 2, 1, 24)) == 100


def plain_runs(rows, min_lines=2):
    """Every run that was seen before, in a dictionary; equal rows count as one."""
    seen, gone = set(), {}
    for r in sorted(set((r[0], r[1]) for r in rows if r[1]), key=lambda x: x[0]):
        own = r[1].split("\n")
        solid = [i for i, x in enumerate(own) if x.strip(" \t\n\x0b\x0c\r")]
        for first, last in zip(solid, solid[min_lines - 1:]):
            run = tuple(own[first:last + 1])
            if run in seen:
                gone.setdefault(r, set()).update(range(first, last + 1))
            seen.add(run)
    out = []
    for r in rows:
        if r[1] is None:
            out.append((r[0], None, 0, 0))
            continue
        own, lost = r[1].split("\n"), gone.get((r[0], r[1]), set())
        left = "\n".join(x for i, x in enumerate(own) if i not in lost)
        if lost and not left.strip(" \t\n\x0b\x0c\r"):
            left, lost = "", own
        out.append((r[0], left, len(own), len(lost)))
    return sorted(out, key=repr)


def test_passages_go_whole(spark):
    """Passages of two lines and more leave nothing behind, whatever stands around them."""
    rng = random.Random(6)
    rows, passages = [], {}
    for size in (2, 3, 4, 5, 6, 14):
        shared = [f"line {i} of the passage of {size}." for i in range(size)]
        for copy in range(8):
            own = [rng.choice([f"line {rng.random()} of its own.", ""]) for _ in range(rng.randrange(1, 30))]
            at = rng.randrange(len(own) + 1)
            number = 100 * size + copy
            passages[number] = shared
            rows.append(row(number, "\n".join(own[:at] + shared + own[at:])))
    rows += [row(5000, "same\nlines\n" * 40), row(5001, None), row(5002, ""), row(5003, "\n\n\n\n"),
             row(5004, "a one\n\nb two\n"), row(5005, "\na one\n\nb two\n\n"), row(5006, "a one\nb two")]
    df = lines.dedup_passages(frame(spark, rows))
    got = sorted(
        map(tuple, df.select("doc_id", "clean_text", "n_lines", "n_removed_lines").collect()), key=repr
    )
    assert got == plain_runs(rows)
    left = {r[0]: r[1] for r in got}
    for number, shared in passages.items():
        stays = [x for x in left[number].split("\n") if "passage" in x]
        assert stays == (shared if number % 100 == 0 else [])
    assert left[5005] == "" and left[5006] == "a one\nb two"


def test_runs_of_odd_rows(spark):
    odd = [r for r in odd_rows() if r[0] is not None]
    df = lines.dedup_passages(frame(spark, odd))
    assert sorted(
        map(tuple, df.select("doc_id", "clean_text", "n_lines", "n_removed_lines").collect()), key=repr
    ) == plain_runs(odd)
    assert lines.dedup_passages(frame(spark, odd_rows())).count() == len(odd_rows())
    assert lines.dedup_passages(frame(spark, [])).count() == 0


def test_repeated_chunks_settle_most_runs(spark):
    """Copies are found as chunks; only runs outside of them are compared one by one."""
    rng = random.Random(9)
    texts = ["\n".join(f"line {rng.random()}" for _ in range(60)) for _ in range(5)]
    rows = [row(10 * copy + n, text) for n, text in enumerate(texts) for copy in range(6)]
    docs = frame(spark, rows).select("doc_id", "text")
    every = sum(59 for _ in rows)
    seen = {}
    plain_held = lines.held

    def watched(df, name):
        seen[name] = plain_held(df, name)
        return seen[name]

    lines.held = watched
    try:
        cleaned = lines.dedup_passages(docs)
        assert cleaned.filter("n_removed_lines = 60").count() == 25
    finally:
        lines.held = plain_held
    assert seen["runs"].count() < 0.62 * every


def test_chunks_and_runs_cover_every_pair():
    rng = random.Random(10)
    for _ in range(200):
        own = [rng.choice([b"", b" ", b"a", b"b", b"c%d" % rng.randrange(50)]) for _ in range(rng.randrange(40))]
        solid = [i for i, x in enumerate(own) if x.strip()]
        parts = lines._chunks_and_runs(own, 2, 1, 24, 2)
        runs = sorted(run for _, _, runs in parts for run in runs)
        assert runs == [(a, b + 1) for a, b in zip(solid, solid[1:])]
        for start, end, inside in parts:
            assert all(start <= a and b <= end for a, b in inside) or (start, end) == (0, 0)
