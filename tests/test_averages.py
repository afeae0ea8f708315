"""Averages, whole and in blocks, against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import plan_text, rows
from rillflow.operators import averages
from rillflow.plans.blocks import BLOCK, plan_blocks

START = datetime(2024, 1, 1)


def running(data):
    sums, out = {}, []
    for key, order, value in sorted(data, key=lambda row: row[1]):
        count, total = sums.get(key, (0, 0.0))
        if value is not None:
            count, total = count + 1, total + value
        sums[key] = (count, total)
        out.append((key, order, total / count if count else None))
    return out


def close(left, right):
    left, right = sorted(left, key=repr), sorted(right, key=repr)
    assert len(left) == len(right)
    for a, b in zip(left, right):
        assert a[:-1] == b[:-1]
        assert a[-1] == pytest.approx(b[-1]) if b[-1] is not None else a[-1] is None


def one_hot_key(size=600, seed=1):
    """A third of all rows under one key, one key null, some values null."""
    rand = random.Random(seed)
    keys = ["hot"] * (size // 3) + [None] * (size // 6)
    keys += [f"k{n % 40}" for n in range(size - len(keys))]
    rand.shuffle(keys)
    return [
        (key, n, None if rand.random() < 0.1 else rand.uniform(-5, 5)) for n, key in enumerate(keys)
    ]


@pytest.mark.parametrize("block_rows", [None, 90, 25, 3])
def test_running_average(spark, block_rows):
    data = one_hot_key()
    df = spark.createDataFrame(data, "k string, n long, v double")
    result = averages.running_average(df, ["k"], "v", "n", block_rows=block_rows)
    close([(r.k, r.n, r.average) for r in result.collect()], running(data))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    data=st.lists(
        st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(-9, 9))),
        min_size=1, max_size=40,
    ),
    block_rows=st.integers(1, 12),
)
def test_running_average_any_blocks(spark, data, block_rows):
    numbered = [(k, n, None if v is None else float(v)) for n, (k, v) in enumerate(data)]
    df = spark.createDataFrame(numbered, "k string, n long, v double")
    result = averages.running_average(df, ["k"], "v", "n", block_rows=block_rows)
    close([(r.k, r.n, r.average) for r in result.collect()], running(numbered))


def test_blocks_bound_the_rows_of_a_hot_key(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") * F.col("id")).alias("n"),
    )
    plan = plan_blocks(df, ["k"], "n", 500)
    sizes = plan.tag(df).groupBy("k", BLOCK).count().collect()
    assert max(row["count"] for row in sizes) <= 2 * 500
    assert {row["k"] for row in sizes if row[BLOCK] > 0} == {"hot"}
    assert sum(row["count"] for row in sizes) == 20_000


def test_no_hot_key_no_blocks(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 50)
    assert plan_blocks(df, ["k"], "id", 10) is None


def test_order_column_must_be_a_position(spark):
    df = spark.createDataFrame([("a", "b")] * 3, "k string, n string")
    with pytest.raises(TypeError):
        plan_blocks(df, ["k"], "n", 1)


def test_rows_are_shuffled_once_per_branch(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), "id", F.rand(1).alias("v"))
    plan = plan_text(averages.running_average(df, ["k"], "v", "id", block_rows=100))
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_totals_add_up(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, v double")
    assert rows(averages.total_average(df, ["k"], "v")) == [("a", 2.0), ("b", 5.0)]
    assert rows(averages.partial_sums(df, ["k"], "v")) == [("a", 2, 4.0), ("b", 1, 5.0)]
    assert plan_text(averages.total_average(df, ["k"], "v")).count("HashAggregate") >= 2


def silent(data, gap):
    """Emissions by definition: the next record of the key is more than the gap later."""
    out, by_key = [], {}
    for key, second, value in sorted(data, key=lambda row: (row[0], row[1])):
        by_key.setdefault(key, {}).setdefault(second, []).append(value)
    for key, moments in by_key.items():
        seen, ordered = [], sorted(moments)
        for here, following in zip(ordered, [*ordered[1:], None]):
            seen += moments[here]
            if following is None or following - here > gap:
                out.append((key, here, sum(seen) / len(seen)))
    return out


def inactivity(spark, data, **options):
    df = spark.createDataFrame(
        [(k, START + timedelta(seconds=s), v) for k, s, v in data],
        "k string, ts timestamp, v double",
    )
    result = averages.inactivity_average(df, ["k"], "v", "ts", 5, **options)
    return [(r.k, int((r.ts - START).total_seconds()), r.average) for r in result.collect()]


def test_inactivity_emissions(spark):
    data = [("a", 0, 1.0), ("a", 3, 2.0), ("a", 9, 6.0)]
    assert sorted(inactivity(spark, data)) == [("a", 3, 1.5), ("a", 9, 3.0)]


def test_a_record_exactly_one_gap_later_keeps_the_key_active(spark):
    data = [("a", 0, 1.0), ("a", 5, 2.0), ("a", 5, 3.0)]
    assert inactivity(spark, data) == [("a", 5, 2.0)]


@pytest.mark.parametrize("block_rows", [None, 60, 10, 2])
def test_inactivity_with_a_hot_key(spark, block_rows):
    rand = random.Random(4)
    data = [("hot", rand.randrange(4000), rand.uniform(0, 9)) for _ in range(300)]
    data += [("same", 7, 1.0)] * 100
    data += [(f"k{n % 30}", rand.randrange(400), rand.uniform(0, 9)) for n in range(300)]
    close(inactivity(spark, data, block_rows=block_rows), silent(data, 5))


def test_rows_of_one_time_part_into_blocks(spark):
    """One arrival with far more rows than a block, repeated rows among them."""
    df = spark.range(3000).select(
        F.lit("hot").alias("k"), F.when(F.col("id") < 2500, 7).otherwise(F.col("id")).alias("n"),
        (F.col("id") % 400).alias("v"),
    )
    found = plan_blocks(df, ["k"], "n", 100).tag(df)
    sizes = found.groupBy(BLOCK).agg(F.count("*").alias("rows"), F.min("n").alias("low"), F.max("n").alias("high"))
    sizes = sizes.orderBy(BLOCK).collect()
    assert max(row["rows"] for row in sizes) <= 100 and sum(row["rows"] for row in sizes) == 3000
    assert all(a["high"] <= b["low"] for a, b in zip(sizes, sizes[1:]))


def test_no_key_and_no_bound_passes_the_driver(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id", F.rand(1).alias("v"))
    plan = plan_text(averages.running_average(df, ["k"], "v", "id", block_rows=10))
    assert "LocalTableScan" not in plan and "array(" not in plan
