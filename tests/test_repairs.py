"""Cases that the given tables do not bring up."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import plan_text, rows
from rillflow.functions import payloads
from rillflow.operators import averages, lookup, prices, reference

RECORD = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("t", T.StringType())])


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_numbers_in_other_forms(spark):
    good = texts(spark, ['{"n": "7", "t": "a"}', '{"n": 1.9}', '{"n": null, "t": "b"}', '{"n": -3}'])
    assert rows(payloads.decode(good, RECORD)) == sorted(
        [(7, "a"), (1, None), (0, "b"), (-3, None)], key=repr
    )


@pytest.mark.parametrize("bad", [None, "", "  ", '{"n": "seven"}', '{"n": 99999999999}', "{"])
def test_no_row_is_made_up(spark, bad):
    with pytest.raises(Exception):
        payloads.decode(texts(spark, [bad]), RECORD).collect()
    kept, diverted = payloads.decode_or_divert(texts(spark, [bad, '{"n": 1}']), RECORD)
    assert rows(kept) == [(1, None)] and rows(diverted) == [(bad,)]


def test_text_after_an_object(spark):
    customers = spark.createDataFrame(
        [(1, "Ann", 30, "street", "2026-01-01 00:00:00")], "id int, name string, age int, address string, c string"
    ).withColumn("created_at", F.col("c").cast("timestamp")).drop("c")
    values = [
        '{"customer_id": 1} junk', '{"customer_id": 1} {"a":2}', '{"customer_id": 1, "x": {"y": 1}}',
        '{"customer_id": 1}}', '{"customer_id": 1},{"b": 1}',
    ]
    found = lookup.enrich_json(texts(spark, values), customers)
    got = found.select(
        F.try_parse_json("value").isNotNull(), F.get_json_object("value", "$.customer_name"),
        F.col("value").rlike(r"\}$"), F.regexp_count("value", F.lit("junk|\"[ab]\"")),
    ).distinct().collect()
    assert [tuple(r) for r in got] == [(True, "Ann", True, 0)]
    twice = lookup.enrich_json(texts(spark, ['{"customer_id": 5, "customer_id": 1}']), customers)
    assert '"Ann"' in twice.first()[0]


def test_rows_without_a_key_are_spread(spark):
    left = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("k"), F.col("id").alias("row")
    )
    table = spark.range(40).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    for hot_rows in (10**6, 30):
        joined = lookup.lookup_join(
            left, table, "k", "key", salts=16, hot_rows=hot_rows, broadcast_rows=0
        )
        assert joined.count() == 4000
        assert joined.filter("k IS NULL").agg(F.count("name")).first()[0] == 0
        assert joined.filter("name IS NOT NULL").count() == 1600


def test_lines_are_split_once(spark):
    lines = texts(spark, ["date,open", "2020-01-02,1,2,3,4,5"])
    plan = plan_text(prices.parse_prices(lines).select("date", "open"))
    assert plan.count("split(value") == plan.count("split(") <= 2
    optimized = prices.parse_prices(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("split(") == 1


def test_rows_without_a_time_do_not_count(spark):
    df = spark.createDataFrame(
        [("a", 2.0, "2026-01-01 00:00:00"), ("a", 100.0, None)], "k string, v double, t string"
    ).withColumn("t", F.col("t").cast("timestamp"))
    assert [r["average"] for r in averages.inactivity_average(df, ["k"], "v", "t").collect()] == [2.0]


def test_a_running_average_is_a_double(spark):
    df = spark.createDataFrame([(1, i, i) for i in range(9)], "k int, o long, v long").withColumn(
        "v", F.col("v").cast("decimal(10,2)")
    )
    whole = averages.running_average(df, ["k"], "v", "o")
    cut = averages.running_average(df, ["k"], "v", "o", block_rows=2)
    assert whole.schema == cut.schema and rows(whole) == rows(cut)


def test_no_arrival_is_before_everything(spark):
    telemetry = spark.createDataFrame([(1, None), (1, 0), (1, 5), (1, 9)], "k int, arrival int")
    records = spark.createDataFrame([(1, 3, "a"), (1, 7, "b"), (1, None, "z")], "k int, arrival int, name string")
    for known, want in ((records.filter("name <> 'z'"), "aaab"), (records, "zzab")):
        for bound in (100_000, 0):
            joined = reference.reference_join(
                telemetry, known, ["k"], ["name"], held="held", broadcast_rows=bound
            )
            found = {r["arrival"]: r["name"] for r in joined.collect()}
            assert "".join(found[at] for at in (None, 0, 5, 9)) == want


def test_records_are_parsed_once_and_not_inside_a_filter(spark):
    lines = spark.range(4).select(F.format_string('{"n": %d, "t": "x"}', "id").alias("value"))
    kept, diverted = payloads.decode_or_divert(lines, RECORD)
    for frame in (payloads.decode(lines, RECORD), kept, diverted):
        executed = frame._jdf.queryExecution().executedPlan().toString().splitlines()
        parses = [line for line in executed if "from_json(" in line]
        assert len(parses) == 1 and "Filter" not in parses[0] and parses[0].count("from_json(") == 1
    assert rows(kept) == [(n, "x") for n in range(4)] and rows(diverted) == []
