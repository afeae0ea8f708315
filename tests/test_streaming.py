"""Streams against their batch forms, restarts and replays."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frames import plan_text, rows
from rillflow import schemas
from rillflow.operators import averages, dashboard, reference, versions
from rillflow.plans import jobs
from rillflow.sinks import serving
from rillflow.streaming import averages as stream_averages
from rillflow.streaming import run
from rillflow.streaming.reference import reference_join_stream, waiting_state
from rillflow.streaming.reference_tables import ReferenceJoin

START = datetime(2026, 5, 3, 20)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each partition costs a state store and a Python worker per batch."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


KAFKA_ROW = "value string, topic string, partition int, offset long, timestamp timestamp"


class Feed:
    """A folder that records are landed in, one file per call."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path, schema
        spark.createDataFrame([], schema).write.parquet(path)

    def land(self, records):
        df = self.spark.createDataFrame(records, self.schema).coalesce(1)
        df.write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.path)


def drain(df, name, root):
    """Process what has landed, then stop."""
    run.start_parquet(df, name, f"{root}/checkpoint", f"{root}/{name}", run.BOUNDED).awaitTermination()


TELEMETRY = (
    "date timestamp, driver_number int, session_key long, meeting_key long, x long, y long, "
    "z long, version long"
)
DRIVERS = (
    "meeting_key int, session_key int, driver_number int, full_name string, "
    "name_acronym string, team_name string, headshot_url string, version long"
)


def spot(driver, version, session=1):
    at = START + timedelta(microseconds=version)
    return (at, driver, session, 1, -version, 2**53 + version, 0, version)


def driver(number, version, session=1):
    return (1, session, number, f"name {number} {version}", "ABC", None, 'quote " and \\', version)


def test_reference_join_over_batches_and_restarts(spark, folder):
    """One batch per step, with the query stopped in between."""
    telemetry, drivers = Feed(spark, folder(), TELEMETRY), Feed(spark, folder(), DRIVERS)
    root = folder()
    steps = [
        ([spot(1, 1), spot(2, 2), spot(1, 3, session=2), spot(1, 4)], []),
        ([], [driver(1, 5), driver(9, 6)]),
        ([spot(1, 7)], [driver(1, 8)]),
        ([spot(1, 9), spot(2, 10)], []),
        ([], [driver(2, 11)]),
    ]
    all_telemetry, all_drivers = [], []
    for landed_telemetry, landed_drivers in steps:
        for feed, landed in ((telemetry, landed_telemetry), (drivers, landed_drivers)):
            if landed:
                feed.land(landed)
        all_telemetry += landed_telemetry
        all_drivers += landed_drivers
        drain(
            reference_join_stream(telemetry.stream(), drivers.stream(), salts=3), "join", root
        )
    streamed = spark.read.parquet(f"{root}/join")
    batch = reference.reference_join(
        spark.createDataFrame(all_telemetry, TELEMETRY),
        spark.createDataFrame(all_drivers, DRIVERS),
        arrival="version",
    )
    assert rows(streamed.select(*batch.columns)) == rows(batch)
    assert streamed.count() == 6
    assert {r.y - r.version for r in streamed.collect()} == {2**53}


def test_reference_join_when_all_comes_at_once(spark, folder):
    """Held rows of a batch take its first record, later batches its last."""
    telemetry, drivers = Feed(spark, folder(), TELEMETRY), Feed(spark, folder(), DRIVERS)
    root = folder()
    telemetry.land([spot(1, n) for n in range(1, 50)])
    drivers.land([driver(1, 60), driver(1, 55), driver(1, 70)])
    stream = lambda: reference_join_stream(telemetry.stream(), drivers.stream(), salts=2)
    drain(stream(), "join", root)
    telemetry.land([spot(1, 100)])
    drain(stream(), "join", root)
    names = {r.version: r.full_name for r in spark.read.parquet(f"{root}/join").collect()}
    assert len(names) == 50
    assert {names[n] for n in range(1, 50)} == {"name 1 55"} and names[100] == "name 1 70"


def test_held_rows_can_be_read(spark, folder):
    telemetry, drivers = Feed(spark, folder(), TELEMETRY), Feed(spark, folder(), DRIVERS)
    root = folder()
    telemetry.land([spot(1, 1), spot(2, 2), spot(2, 3)])
    drivers.land([driver(1, 5)])
    drain(reference_join_stream(telemetry.stream(), drivers.stream(), salts=2), "join", root)
    schema = spark.createDataFrame([], TELEMETRY).schema
    held = waiting_state(spark, f"{root}/checkpoint/join", schema)
    assert rows(held) == rows(spark.createDataFrame([spot(2, 2), spot(2, 3)], TELEMETRY))


def test_running_average_stream_follows_the_batches(spark, folder):
    schema = "k string, n long, v double"
    feed, root = Feed(spark, folder(), schema), folder()
    data = []
    for n in range(4):
        record = ("ab"[n == 1], n, None if n == 2 else float(n))
        data.append(record)
        feed.land([record])
        drain(stream_averages.running_average_stream(feed.stream(), ["k"], "v"), "avg", root)
    batch = averages.running_average(spark.createDataFrame(data, schema), ["k"], "v", "n")
    assert rows(spark.read.parquet(f"{root}/avg").select(*batch.columns)) == rows(batch)


def test_running_average_stream_keeps_exact_columns(spark, folder):
    feed, root = Feed(spark, folder(), "k long, big long, at timestamp, v double"), folder()
    at = datetime(2026, 1, 1, 0, 0, 0, 123456)
    feed.land([(1, 2**60 + 1, at, 1.0), (1, None, None, 3.0)])
    drain(stream_averages.running_average_stream(feed.stream(), ["k"], "v"), "avg", root)
    read = {(r.big, r.at) for r in spark.read.parquet(f"{root}/avg").collect()}
    assert read == {(2**60 + 1, at), (None, None)}


@pytest.mark.parametrize("block_rows", [None, 4])
def test_running_average_batches(spark, folder, block_rows):
    schema = "k string, n long, v double"
    feed, root, out = Feed(spark, folder(), schema), folder(), folder()
    rand = random.Random(6)
    data = [("hot" if rand.random() < 0.5 else rand.choice("ab"), n, float(n)) for n in range(40)]

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    step = stream_averages.running_average_batches(
        ["k"], "v", "n", f"{root}/sums", keep, block_rows=block_rows
    )

    def twice(batch, batch_id):
        step(batch, batch_id)
        step(batch, batch_id)  # as if the batch had failed after its last write

    for start in range(0, 40, 14):
        feed.land(data[start:start + 14])
        run.start(feed.stream(), "batches", root, twice, trigger=run.BOUNDED).awaitTermination()
    batch = averages.running_average(spark.createDataFrame(data, schema), ["k"], "v", "n")
    streamed = sorted(spark.read.parquet(out).select(*batch.columns).collect())
    for found, expected in zip(streamed, sorted(batch.collect()), strict=True):
        assert found[:3] == expected[:3] and found[3] == pytest.approx(expected[3])


def test_partial_sums_keep_null_keys(spark):
    df = spark.createDataFrame(
        [(2**60 + 1, 5, 1.0, 1), (None, 7, 2.0, 1), (None, 3, 3.0, 1)],
        "k long, micros_ long, value_ double, count_ long",
    ).coalesce(1)
    summed = df.mapInArrow(stream_averages.partial_sums_of(["k"]), df.schema)
    assert rows(summed) == rows(spark.createDataFrame(
        [(2**60 + 1, 5, 1.0, 1), (None, 7, 5.0, 2)], df.schema
    ))


def test_average_updates(spark, folder):
    feed, seen = Feed(spark, folder(), "k string, v double"), []
    root = folder()
    updates = stream_averages.average_updates(feed.stream(), ["k"], "v")
    for landed in ([("a", 1.0), ("b", 5.0)], [("a", 3.0)]):
        feed.land(landed)
        run.start(
            updates, "updates", root, lambda batch, n: seen.append(rows(batch)), "update", run.BOUNDED
        ).awaitTermination()
    assert seen == [[("a", 1.0), ("b", 5.0)], [("a", 2.0)]]


def test_inactivity_stream(spark, folder):
    """Every emission the watermark has passed is the one the batch form gives."""
    feed, root = Feed(spark, folder(), "k string, ts timestamp, v double"), folder()
    at = lambda second: START + timedelta(seconds=second)
    data = [
        ("a", 0, 1.0), ("a", 3, 2.0), ("b", 9, 4.0), ("a", 10, 6.0), ("b", 16, 2.0), ("a", 30, 1.0),
    ]
    for key, second, value in data:
        feed.land([(key, at(second), value)])
        drain(
            stream_averages.inactivity_average_stream(feed.stream(), ["k"], "v", "ts", 5), "silent", root
        )
    streamed = rows(spark.read.parquet(f"{root}/silent"))
    assert set(streamed) == {("a", at(3), 1.5), ("a", at(10), 3.0), ("b", at(16), 3.0)}
    assert len(streamed) == 3
    batch = averages.inactivity_average(
        spark.createDataFrame([(k, at(s), v) for k, s, v in data], "k string, ts timestamp, v double"),
        ["k"], "v", "ts", 5,
    )
    assert set(streamed) <= set(rows(batch))


def message(topic, part, offset, **value):
    return (json.dumps(value), topic, part, offset, START)


def test_race_job(spark, folder):
    """Topics to serving tables and dashboard, with a restart and a replay."""
    key = {"meeting_key": 1, "session_key": 2, "driver_number": 44}
    feeds = {topic: Feed(spark, folder(), KAFKA_ROW) for topic in schemas.FEEDS}
    tables, checkpoints = folder(), folder()

    def land(topic, part, offset, **value):
        feeds[topic].land([message(topic, part, offset, **{**key, **value})])

    def drain_all(checkpoint_root):
        queries = jobs.race_telemetry(
            {topic: feed.stream() for topic, feed in feeds.items()},
            jobs.folder_writer(tables), checkpoint_root, run.BOUNDED, salts=2,
        )
        for query in queries:
            query.awaitTermination()

    land("position", 1, 0, date="2026-05-03T20:00:00Z", position=3, version=999)
    land("location", 0, 0, date="2026-05-03T20:00:00.5+00:00", x=-5, y=7, unknown="field")
    land("car_data", 2, 5, date="2026-05-03T20:00:01", speed=301, n_gear=8)
    drain_all(checkpoints)
    land("drivers", 0, 0, full_name="Lewis", name_acronym="LEW", team_name="T", headshot_url="u")
    land("position", 1, 1, date="2026-05-03T20:00:09Z", position=1)
    drain_all(checkpoints)

    read = lambda table: serving.read_path(spark, table, f"{tables}/{table}")
    assert [r.position for r in dashboard.current_positions(read("position")).collect()] == [1]
    car = read("car_data").first()
    assert (car.version, car.speed, car.throttle, car.name_acronym) == (2_000_000_000_005, 301, 0, "LEW")
    assert read("location").first().x == -5
    before = {t: rows(versions.consistent_read(read(t))) for t in jobs.TELEMETRY}

    drain_all(folder())  # a replay from the beginning, into the same tables
    for table in jobs.TELEMETRY:
        assert read(table).count() == 2 * len(before[table])
        assert rows(versions.consistent_read(read(table))) == before[table]
    assert read("drivers").count() == 2 and read("drivers").distinct().count() == 1


def test_query_names_fix_the_checkpoint(spark, folder):
    feed, root, seen = Feed(spark, folder(), "v long"), folder(), []
    feed.land([(1,)])
    for _ in range(2):
        run.start(
            feed.stream().select(F.col("v")), "named", root,
            lambda batch, n: seen.extend(r.v for r in batch.collect()), trigger=run.BOUNDED,
        ).awaitTermination()
    assert seen == [1]


def silent_rows(spark, folder, data, cuts, retried=False, **options):
    """What the batch-wise inactivity average gives out of ``data`` cut at ``cuts``."""
    schema = "k string, ts timestamp, v double"
    feed, root, out = Feed(spark, folder(), schema), folder(), folder()

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    step = stream_averages.inactivity_average_batches(
        ["k"], "v", "ts", f"{root}/state", keep, 5, **options
    )

    def twice(batch, batch_id):
        step(batch, batch_id)
        step(batch, batch_id)

    for start, end in zip([0, *cuts], [*cuts, len(data)]):
        feed.land(data[start:end])
        run.start(
            feed.stream(), "silent", root, twice if retried else step, trigger=run.BOUNDED
        ).awaitTermination()
    return [(r.k, r.ts, round(r.average, 9)) for r in spark.read.parquet(out).orderBy("k", "ts").collect()]


@pytest.mark.parametrize("block_rows", [None, 6])
def test_every_silence_however_the_stream_is_cut(spark, folder, block_rows):
    rand, at, data = random.Random(3), 0.0, []
    for n in range(160):
        at += rand.choice([0.0, 0.5, 3.0, 5.0])
        key = rand.choice(["hot", "hot", "a", None])
        data.append((key, START + timedelta(seconds=at), None if n % 11 == 0 else float(n)))
    batch = averages.inactivity_average(
        spark.createDataFrame(data, "k string, ts timestamp, v double"), ["k"], "v", "ts", 5
    )
    newest = max(ts for _, ts, _ in data)
    want = sorted(
        ((r.k, r.ts, round(r.average, 9)) for r in batch.collect() if r.ts + timedelta(seconds=5) < newest),
        key=lambda r: (r[0] is not None, r),
    )
    assert len(want) > 8
    assert silent_rows(spark, folder, data, [], block_rows=block_rows) == want
    cut = silent_rows(spark, folder, data, [40, 41, 90, 150], retried=True, block_rows=block_rows)
    assert cut == want


def test_lateness_waits_and_late_rows_are_left_out(spark, folder):
    at = lambda second: START + timedelta(seconds=second)
    data = [("a", at(0), 1.0), ("a", at(20), 3.0), ("a", at(4), 5.0), ("a", at(40), 7.0), ("a", None, 9.0)]
    assert silent_rows(spark, folder, data, [2, 3]) == [("a", at(0), 1.0), ("a", at(20), 2.0)]
    assert silent_rows(spark, folder, data, [2, 3], lateness_seconds=18.0) == [("a", at(4), 3.0)]


def test_replaced_timers_are_deleted(spark, folder):
    feed, root = Feed(spark, folder(), "k string, ts timestamp, v double"), folder()
    for second in (0, 2, 4):
        feed.land([(key, START + timedelta(seconds=second), 1.0) for key in "ab"])
        drain(
            stream_averages.inactivity_average_stream(feed.stream(), ["k"], "v", "ts", 60), "silent", root
        )
    timers = (
        spark.read.format("statestore").option("readRegisteredTimers", True).load(f"{root}/checkpoint/silent")
    )
    assert timers.count() == 2


def joined_rows(spark, folder, steps, retried=False, **options):
    """Rows of the table-based join after all steps, and the join."""
    telemetry, drivers = Feed(spark, folder(), TELEMETRY), Feed(spark, folder(), DRIVERS)
    root, out = folder(), folder()
    join = ReferenceJoin(telemetry.stream(), drivers.stream(), f"{root}/tables", **options)

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def twice(batch, batch_id):
        join.step(keep)(batch, batch_id)
        join.step(keep)(batch, batch_id)

    for landed in steps:
        for feed, records in zip((telemetry, drivers), landed):
            if records:
                feed.land(records)
        run.start(
            join.inputs(), "join", root, twice if retried else join.step(keep), trigger=run.BOUNDED
        ).awaitTermination()
    return spark.read.parquet(out).drop("batch"), join


STEPS = [
    ([spot(1, 1), spot(2, 2), spot(1, 3, session=2), spot(1, 4)], []),
    ([], [driver(1, 5), driver(9, 6)]),
    ([spot(1, 7)], [driver(1, 8)]),
    ([spot(1, 9), spot(2, 10)], []),
    ([(START, None, 1, 1, 0, 0, 0, 12)], [driver(2, 11)]),
]


@pytest.mark.parametrize("options", [
    {}, {"full_every": 2}, {"full_every": 1, "broadcast_rows": 0, "salts": 3, "hot_rows": 1},
])
def test_table_join_over_batches_and_restarts(spark, folder, options):
    found, join = joined_rows(spark, folder, STEPS, retried=bool(options), **options)
    batch = reference.reference_join(
        spark.createDataFrame([r for step in STEPS for r in step[0]], TELEMETRY),
        spark.createDataFrame([r for step in STEPS for r in step[1]], DRIVERS), arrival="version",
    )
    # Held rows go out once.
    assert rows(found.select(*batch.columns)) == rows(batch)
    assert {r.version for r in join.waiting(spark, len(STEPS)).collect()} == {3}


def test_table_join_takes_the_first_record_then_the_last(spark, folder):
    found, _ = joined_rows(spark, folder, [
        ([spot(1, n) for n in range(1, 50)], [driver(1, 60), driver(1, 55), driver(1, 70)]),
        ([spot(1, 100)], [driver(1, 10)]),
        ([spot(1, 101)], []),
    ])
    names = {r.version: r.full_name for r in found.collect()}
    assert len(names) == 51 and {names[n] for n in range(1, 50)} == {"name 1 55"}
    assert (names[100], names[101]) == ("name 1 70", "name 1 10")


def test_table_join_forgets_rows_after_a_while(spark, folder):
    found, join = joined_rows(
        spark, folder, [([spot(1, 1)], []), ([], [driver(1, 2)])], ttl_seconds=0.0
    )
    assert found.count() == 0


def test_table_join_has_no_python(spark, folder):
    telemetry, drivers = Feed(spark, folder(), TELEMETRY), Feed(spark, folder(), DRIVERS)
    telemetry.land([spot(1, 1)])
    drivers.land([driver(1, 2)])
    join, plans = ReferenceJoin(telemetry.stream(), drivers.stream(), folder()), []
    run.start(
        join.inputs(), "join", folder(), join.step(lambda batch, _: plans.append(plan_text(batch))),
        trigger=run.BOUNDED,
    ).awaitTermination()
    assert plans and not any(word in plan for plan in plans for word in ("Python", "Pandas", "Arrow", "from_json"))


def test_a_restart_with_another_layout_fails(spark, folder):
    telemetry, drivers = Feed(spark, folder(), TELEMETRY), Feed(spark, folder(), DRIVERS)
    telemetry.land([spot(1, 1)])
    drivers.land([driver(1, 2)])
    root, out = folder(), folder()

    def begin(salts):
        joined = reference_join_stream(telemetry.stream(), drivers.stream(), salts=salts)
        return run.start_parquet(joined, "join", root, out, run.BOUNDED, layout={"salts": salts})

    with run.state_per_core(spark):
        begin(2).awaitTermination()
        begin(2).awaitTermination()
        with pytest.raises(ValueError, match="salts was 2, is 3"):
            begin(3)

    tables, checkpoint = folder(), folder()

    def step(**options):
        join = ReferenceJoin(telemetry.stream(), drivers.stream(), tables, **options)
        run.start(
            join.inputs(), "tables", checkpoint, join.step(lambda batch, _: batch.count()), trigger=run.BOUNDED
        ).awaitTermination()

    step(full_every=2)
    telemetry.land([spot(1, 3)])
    with pytest.raises(Exception, match="full_every was 2, is 4"):
        step(full_every=4)
    step(full_every=2)


def test_table_join_runs_its_batch_once(spark, folder):
    telemetry, drivers = Feed(spark, folder(), TELEMETRY), Feed(spark, folder(), DRIVERS)
    telemetry.land([spot(1, n) for n in range(20)])
    drivers.land([driver(1, 2)])
    ran = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(key):
        ran.add(1)
        return key

    rows_in = telemetry.stream()
    key = ReferenceJoin.keys[-1]
    counted = rows_in.withColumn(key, seen.asNondeterministic()(key).cast(rows_in.schema[key].dataType))
    found = []
    join = ReferenceJoin(
        counted.select(*rows_in.columns), drivers.stream(), folder(), broadcast_rows=0, salts=3, hot_rows=5
    )
    run.start(
        join.inputs(), "once", folder(), join.step(lambda batch, _: found.append(batch.count())),
        trigger=run.BOUNDED,
    ).awaitTermination()
    assert sum(found) == 20 and ran.value == 20
