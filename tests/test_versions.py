"""Newest versions, latest values and dashboard reads."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from frames import plan_text, rows
from rillflow import schemas
from rillflow.operators import dashboard, versions

START = datetime(2026, 5, 3, 20)


def table(spark, feed, records):
    """Serving rows from (driver, seconds, version, *measures)."""
    names = [*schemas.MEASURES[feed]]
    data = [
        (START + timedelta(seconds=second), 1, 1, driver, version, *measures)
        for driver, second, version, *measures in records
    ]
    df = spark.createDataFrame(
        data, "date timestamp, meeting_key long, session_key long, driver_number int, "
        "version long, " + ", ".join(f"{name} int" for name in names)
    )
    for column in schemas.DRIVER_COLUMNS:
        df = df.withColumn(column, F.concat(F.lit(column), "driver_number"))
    return df.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SERVING[feed].fields
    ])


def test_highest_version_stays(spark):
    df = spark.createDataFrame(
        [("a", 5, "old"), ("a", 9, "new"), ("b", 1, None), ("a", 9, "new"), (None, 1, "n")],
        "k string, version long, v string",
    )
    expected = rows(spark.createDataFrame([("a", 9, "new"), ("b", 1, None), (None, 1, "n")], df.schema))
    assert rows(versions.newest_version(df, ["k"])) == expected
    assert rows(versions.newest_version_ranked(df, ["k"])) == expected


def test_both_forms_agree_on_ties(spark):
    rand = random.Random(3)
    data = [("hot" if n % 3 else f"k{n}", rand.randrange(5), rand.randrange(9)) for n in range(300)]
    df = spark.createDataFrame(data, "k string, version long, v int")
    assert rows(versions.newest_version(df, ["k"])) == rows(versions.newest_version_ranked(df, ["k"]))


def test_copies_are_reduced_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("version"))
    plan = plan_text(versions.newest_version(df, ["k"]))
    assert plan.count("partial_max") >= 1
    assert "WindowGroupLimit" in plan_text(versions.newest_version_ranked(df, ["k"]))


def test_dates_compare_to_the_millisecond(spark):
    records = [(1, 0.0001, 5, 1, 2, 3), (1, 0.0009, 9, 4, 5, 6), (1, 0.002, 1, 7, 8, 9)]
    read = versions.consistent_read(table(spark, "location", records))
    assert sorted((r.version, r.x) for r in read.collect()) == [(1, 7), (9, 4)]


def test_replay_changes_nothing(spark):
    once = table(spark, "location", [(1, 0, 5, -1, -2, -3), (2, 0, 6, 1, 1, 1)])
    assert rows(versions.consistent_read(once.union(once))) == rows(versions.consistent_read(once))
    assert rows(versions.consistent_read(once))[0][4:7] == (-1, -2, -3)


def test_filters_pass_the_consistent_read(spark, folder):
    path = folder()
    table(spark, "location", [(1, 0, 5, 1, 2, 3), (2, 0, 6, 4, 5, 6)]).write.partitionBy(
        *schemas.SERVING_PARTITIONS
    ).parquet(path)
    read = versions.consistent_read(spark.read.parquet(path))
    chosen = read.filter("meeting_key = 1 AND session_key = 1 AND driver_number = 2")
    assert chosen.count() == 1
    plan = plan_text(chosen)
    assert "EqualTo(driver_number,2)" in plan
    assert "PartitionFilters: [isnotnull(meeting_key" in plan


def test_positions_and_cards(spark):
    df = table(spark, "position", [
        (44, 0, 1, 3), (44, 10, 2, 1), (16, 5, 3, 2), (16, 5, 4, 5), (63, 1, 5, 2),
    ])
    assert [(r.driver_number, r.position) for r in dashboard.current_positions(df).collect()] == [
        (44, 1), (63, 2), (16, 5),
    ]
    cards = dashboard.top_cards(df, 2)
    assert [r.driver_number for r in cards.collect()] == [44, 63]
    assert "TakeOrderedAndProject" in plan_text(cards)


def test_latest_measures(spark):
    cars = table(spark, "car_data", [(1, 0, 1, 100, 3, 9, 9, 0), (1, 2, 2, 200, 5, 9, 9, 1)])
    assert [r.speed for r in dashboard.latest_car_data(cars).collect()] == [200]
    spots = table(spark, "location", [(1, 3, 1, -5, 0, 0), (1, 2, 2, 7, 0, 0)])
    assert [r.x for r in dashboard.latest_location(spots).collect()] == [-5]


def test_trace_and_series(spark):
    spots = table(spark, "location", [
        (1, 2, 1, 20, 0, 0), (1, 1, 2, 10, 0, 0), (2, 1, 3, 99, 0, 0), (1, 2, 9, 21, 0, 0),
    ])
    assert [r.x for r in dashboard.track_trace(spots, driver=1).collect()] == [10, 21]
    cars = table(spark, "car_data", [(1, s, s, s, 1, 1, 1, 0) for s in range(6)])
    series = dashboard.telemetry_series(
        cars, F.lit(START + timedelta(seconds=2)), F.lit(START + timedelta(seconds=4)), driver=1
    )
    assert [r.speed for r in series.collect()] == [2, 3]
