"""The reference join: early rows held, each row given out at most once."""

import random

import pytest
from pyspark.sql import functions as F

from frames import plan_text, rows
from rillflow import schemas
from rillflow.operators import reference

KEYS = ["meeting_key", "session_key", "driver_number"]
TELEMETRY = "meeting_key long, session_key long, driver_number int, arrival long, speed int"
DRIVERS = (
    "meeting_key int, session_key int, driver_number int, arrival long, full_name string, "
    "name_acronym string, team_name string, headshot_url string"
)

STRATEGIES = {
    "interval": {},
    "scan": {"broadcast_rows": 0},
    "scan in blocks": {"broadcast_rows": 0, "block_rows": 7},
    "scan in small blocks": {"broadcast_rows": 0, "block_rows": 2},
}


def frames(spark, telemetry, drivers):
    return (
        spark.createDataFrame([(*key, at, 10) for key, at in telemetry], TELEMETRY),
        spark.createDataFrame(
            [(*key, at, name, "A", "T", None) for key, at, name in drivers], DRIVERS
        ),
    )


def joined(spark, telemetry, drivers, **strategy):
    result = reference.reference_join(*frames(spark, telemetry, drivers), held="held", **strategy)
    return sorted(
        (row.session_key, row.driver_number, row.arrival, row.full_name, row.held)
        for row in result.collect()
    )


def expected(telemetry, drivers):
    """Replays the arrivals one by one, holding rows as the definition says."""
    known, held, out = {}, {}, []
    arrivals = [(at, 0, key, name) for key, at, name in drivers]
    arrivals += [(at, 1, key, None) for key, at in telemetry]
    for at, kind, key, name in sorted(arrivals, key=lambda row: row[:2]):
        if kind == 0:
            known[key] = name
            out += [(*key[1:], early, name, True) for early in held.pop(key, [])]
        elif key in known:
            out.append((*key[1:], at, known[key], False))
        else:
            held.setdefault(key, []).append(at)
    return sorted(out)


@pytest.mark.parametrize("strategy", STRATEGIES.values(), ids=STRATEGIES)
def test_early_late_updated_and_unknown(spark, strategy):
    a, b, c, other_session = (1, 1, 1), (1, 1, 2), (1, 1, 3), (1, 2, 1)
    telemetry = [(a, 1), (a, 2), (a, 4), (a, 6), (b, 9), (c, 3), (other_session, 5)]
    drivers = [(a, 3, "first"), (a, 5, "second"), (b, 8, "b"), ((9, 9, 9), 1, "nobody")]
    assert joined(spark, telemetry, drivers, **strategy) == [
        (1, 1, 1, "first", True), (1, 1, 2, "first", True), (1, 1, 4, "first", False),
        (1, 1, 6, "second", False), (1, 2, 9, "b", False),
    ]


@pytest.mark.parametrize("strategy", STRATEGIES.values(), ids=STRATEGIES)
@pytest.mark.parametrize("seed", [1, 2])
def test_random_interleavings(spark, strategy, seed):
    rand = random.Random(seed)
    order = list(range(400))
    rand.shuffle(order)
    # A third of all rows belong to one driver, who also changes often.
    key = lambda: (1, 1, 1) if rand.random() < 0.34 else (1, rand.randrange(3), rand.randrange(9))
    telemetry = [(key(), at) for at in order[:330]]
    drivers = [(key(), at, f"d{at}") for at in order[330:]]
    assert joined(spark, telemetry, drivers, **strategy) == expected(telemetry, drivers)


def test_no_drivers_at_all(spark):
    for strategy in STRATEGIES.values():
        assert joined(spark, [((1, 1, 1), 1)], [], **strategy) == []


def test_repeated_driver_record_does_not_multiply(spark):
    a = (1, 1, 1)
    for strategy in STRATEGIES.values():
        found = joined(spark, [(a, 2)], [(a, 1, "x"), (a, 1, "x"), (a, 3, "x")], **strategy)
        assert found == [(1, 1, 2, "x", False)]


def test_small_reference_leaves_telemetry_in_place(spark):
    telemetry, drivers = frames(spark, [((1, 1, 1), 1)], [((1, 1, 1), 2, "x")])
    plan = plan_text(reference.reference_join(telemetry, drivers))
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" not in plan


def test_many_versions_per_key_use_the_scan(spark):
    a = (1, 1, 1)
    drivers = [(a, at, f"d{at}") for at in range(0, 100, 2)]
    telemetry = [(a, at) for at in range(1, 100, 2)]
    frame = frames(spark, telemetry, drivers)
    plan = plan_text(reference.reference_join(*frame, lookup_versions=10))
    assert "BroadcastHashJoin" not in plan and "Window" in plan
    assert joined(spark, telemetry, drivers, lookup_versions=10) == expected(telemetry, drivers)


def test_waiting_and_known(spark):
    telemetry, drivers = frames(
        spark, [((1, 1, 1), 1), ((1, 1, 2), 2), ((1, 1, 2), 3)],
        [((1, 1, 2), 1, "x"), ((1, 1, 2), 9, "y")],
    )
    assert [r.arrival for r in reference.rows_waiting(telemetry, drivers).collect()] == [1]
    found = reference.of_known_drivers(telemetry, drivers)
    assert sorted(r.arrival for r in found.collect()) == [2, 3]


def test_session_filter_reaches_the_scan(spark, folder):
    path = folder()
    frames(spark, [((1, 1, 1), 1), ((1, 2, 1), 2)], [])[0].write.parquet(path)
    one = reference.of_session(spark.read.parquet(path), 2, 1)
    assert [r.arrival for r in one.collect()] == [2]
    assert "EqualTo(session_key,2)" in plan_text(one)


def test_enriched_row_has_the_table_order(spark):
    columns = list(reversed(schemas.SERVING["location"].fieldNames()))
    df = spark.range(1).select(*[F.lit(1).alias(name) for name in columns])
    assert reference.enriched_row(df, "location").columns == schemas.SERVING["location"].fieldNames()
    assert rows(df.select(reference.driver_known(F.col("full_name")))) == [(True,)]
