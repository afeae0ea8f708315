"""All registered queries against their SQL on the smallest tables."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import registered
from rillflow.streaming import run

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(
            f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'"
        )
    return connection


def plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    number = float(value)
    return None if math.isnan(number) else number


def table_of(names, records):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(
        (tuple(plain(record[at]) for at in order) for record in records), key=repr
    )


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, tables, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    found = table_of(df.columns, df.collect())
    assert found
    sql = entry_points.oracle_sql().get(name)
    if sql:
        result = tables.execute(sql)
        names = [column[0] for column in result.description]
        assert sorted(names) == sorted(df.columns)
        assert found == table_of(names, result.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_landed_parts_are_batches_of_several_files(spark, folder):
    """Parts of 60 events, none and one: each is one batch, and a large one is not one file."""
    data, root, seen = folder(), folder(), {}
    ids = [*range(60), 299, None]
    events = spark.createDataFrame([(n,) for n in ids], "event_id long")
    events.write.parquet(f"{data}/events.parquet")

    def keep(batch, batch_id):
        found = batch.select("event_id", F.input_file_name().alias("file")).collect()
        seen[batch_id] = (sorted(r["event_id"] for r in found), len({r["file"] for r in found}))

    stream = registered.landed(spark, data, root, 3, file_rows=7)
    run.start(stream, "landed", folder(), keep, trigger=run.BOUNDED).awaitTermination()
    assert [seen[n][0] for n in sorted(seen)] == [list(range(60)), [], [299]]
    assert seen[0][1] == 3
