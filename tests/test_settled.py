"""Merged partitions of serving tables, and how appends are laid out."""

import glob

import pytest
from frames import plan_text
from pyspark.sql import functions as F

from rillflow import schemas
from rillflow.operators import versions
from rillflow.sinks import serving, settled


def locations(spark, n, version, sessions=4, late=0):
    """``n`` rows over the sessions, two for each key, as a location table holds them."""
    df = spark.range(n).select(
        F.lit(7).cast("long").alias("meeting_key"), (F.col("id") % sessions).alias("session_key"),
        (F.col("id") % 3).cast("int").alias("driver_number"),
        F.timestamp_seconds(F.floor(F.col("id") / (2 * 3 * sessions)) + late).alias("date"),
        (F.col("id") + version).alias("version"),
        *[F.col("id").cast("int").alias(c) for c in "xyz"],
        *[F.lit("d").alias(c) for c in schemas.DRIVER_COLUMNS],
    )
    return df


def same(spark, path, settled_path):
    whole = versions.consistent_read(serving.read_path(spark, "location", path))
    found = settled.consistent_read_incremental(spark, "location", path, settled_path)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, whole.select(*found.columns).collect()))
    return found


def test_reads_agree_at_every_step(spark, tmp_path):
    path, done = f"{tmp_path}/location", f"{tmp_path}/done"
    settle = lambda closed: settled.settle(spark, "location", path, done, closed)
    serving.append_path(locations(spark, 200, 0), "location", path)
    same(spark, path, done)
    assert settle(lambda at: at["session_key"] < 2) == 2
    same(spark, path, done)
    assert settle(lambda at: at["session_key"] < 2) == 0
    # Newer versions and new keys of merged and of open partitions, and a replay.
    serving.append_path(locations(spark, 120, 1000, late=2), "location", path)
    serving.append_path(locations(spark, 200, 0), "location", path)
    same(spark, path, done)
    assert settle(lambda at: at["session_key"] in (1, 2)) == 2
    same(spark, path, done)
    assert settle(lambda at: True) == 2
    same(spark, path, done)


def test_merged_partitions_are_not_shuffled(spark, tmp_path):
    path, done = f"{tmp_path}/location", f"{tmp_path}/done"
    serving.append_path(locations(spark, 200, 0), "location", path)
    settled.settle(spark, "location", path, done, lambda at: True)
    found = settled.consistent_read_incremental(spark, "location", path, done)
    assert "Exchange" not in plan_text(found)
    # One more file in one partition: only that partition's rows pass an exchange.
    serving.append_path(locations(spark, 200, 5000).filter("session_key = 3"), "location", path)
    found = same(spark, path, done)
    kept, again = plan_text(found).split("Aggregate", 1)[0], plan_text(found)
    assert "Exchange" in again and kept.count("Scan parquet") <= 1
    files = [f for f in found.inputFiles() if "/generation=" not in f]
    assert files and all("session_key=3" in f for f in files)


def test_a_run_that_stopped_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    path, done = f"{tmp_path}/location", f"{tmp_path}/done"
    serving.append_path(locations(spark, 100, 0), "location", path)
    create = type(spark).createDataFrame

    def stopped(self, *rows, **more):
        raise RuntimeError("stopped")

    monkeypatch.setattr(type(spark), "createDataFrame", stopped)
    with pytest.raises(RuntimeError):
        settled.settle(spark, "location", path, done, lambda at: at["session_key"] < 3)
    monkeypatch.setattr(type(spark), "createDataFrame", create)
    same(spark, path, done)
    assert settled.settle(spark, "location", path, done, lambda at: at["session_key"] == 0) == 1
    same(spark, path, done)


def test_partition_values():
    assert settled.partition_values("meeting_key=3/session_key=__HIVE_DEFAULT_PARTITION__") == {
        "meeting_key": 3, "session_key": None,
    }


def test_null_sessions(spark, tmp_path):
    path, done = f"{tmp_path}/location", f"{tmp_path}/done"
    rows = locations(spark, 60, 0).withColumn("session_key", F.expr("nullif(session_key, 1)"))
    serving.append_path(rows, "location", path)
    settled.settle(spark, "location", path, done, lambda at: at["session_key"] is None)
    same(spark, path, done)


def test_appends_run_their_input_once_and_fill_files(spark, tmp_path):
    df = locations(spark, 20_000, 0, sessions=4).withColumn(
        "session_key", F.when(F.col("version") % 10 < 7, 1).otherwise(F.col("session_key"))
    ).repartition(8)
    text = plan_text(serving.laid_out(df, "location"))
    assert "REBALANCE_PARTITIONS_BY_COL" in text and "rangepartitioning" not in text
    files = lambda root, n: len(glob.glob(f"{root}/meeting_key=7/session_key={n}/*.parquet"))
    serving.append_path(df, "location", f"{tmp_path}/few")
    assert [files(f"{tmp_path}/few", n) for n in range(4)] == [1, 1, 1, 1]
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "65536")
    try:
        serving.append_path(df, "location", f"{tmp_path}/hot")
    finally:
        spark.conf.set(key, before)
    assert files(f"{tmp_path}/hot", 1) > 2 >= files(f"{tmp_path}/hot", 2)
