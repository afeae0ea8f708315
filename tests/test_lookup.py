"""Customer enrichment of typed and JSON orders."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from frames import plan_text
from rillflow import schemas
from rillflow.operators import lookup
from rillflow.plans import jobs
from rillflow.plans.sizing import fits_broadcast
from rillflow.streaming import run

CUSTOMERS = [
    (0, "Zero", 20, "addr 0", datetime(2024, 1, 1)),
    (12, "Dozen", 34, "addr 12", datetime(2024, 1, 1, 10, 0, 0, 120450)),
    (3, "Three", 40, None, datetime(2024, 1, 1, 10, 0, 0, 500000)),
    (4, "Four", 50, "addr 4", None),
]
DOZEN = {
    "customer_name": "Dozen", "customer_age": "34", "customer_address": "addr 12",
    "customer_created_at": "2024-01-01 10:00:00.12045",
}
NOBODY = dict.fromkeys(schemas.CUSTOMER_FIELDS)


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, schemas.CUSTOMER)


STRATEGIES = [
    {},
    {"broadcast_rows": 0},
    {"broadcast_rows": 0, "salts": 3},
    {"broadcast_rows": 0, "salts": 3, "hot_rows": 0},
]


def enrich(spark, customers, texts, **sizing):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, value string")
    result = lookup.enrich_json(df, customers, **sizing)
    assert result.columns == ["n", "value"]
    return [row.value for row in result.orderBy("n").collect()]


@pytest.mark.parametrize("sizing", STRATEGIES)
def test_hits_and_misses(spark, customers, sizing):
    hit, miss = enrich(
        spark, customers,
        ['{"customer_id": 12, "amount": 12.5, "note": {"a": [1]}}', ' {"customer_id": 99} \n'],
        **sizing,
    )
    assert json.loads(hit) == {"customer_id": 12, "amount": 12.5, "note": {"a": [1]}, **DOZEN}
    assert list(json.loads(hit)) == ["customer_id", "amount", "note", *schemas.CUSTOMER_FIELDS]
    assert json.loads(miss) == {"customer_id": 99, **NOBODY}


@pytest.mark.parametrize("sizing", STRATEGIES)
def test_unusable_messages_pass_unchanged(spark, customers, sizing):
    texts = [
        "{bad", '{"order_id": 1}', '[{"customer_id": 12}]', '"text"', "", '{"customer_id": 4}',
    ]
    assert enrich(spark, customers, texts, **sizing) == texts


def test_id_coercion(spark, customers):
    texts = ['{"customer_id": "12"}', '{"customer_id": 3.7}', '{"customer_id": null}',
             '{"customer_id": "abc"}', '{"customer_id": true}']
    names = [json.loads(v)["customer_name"] for v in enrich(spark, customers, texts)]
    assert names == ["Dozen", "Three", "Zero", "Zero", None]


def test_existing_fields_are_replaced(spark, customers):
    text = '{"customer_id": 12, "customer_name": "old", "kept": null, "z": [1, {"b": 2}]}'
    enriched = enrich(spark, customers, [text])[0]
    assert enriched.count('"customer_name"') == 1
    assert json.loads(enriched) == {"customer_id": 12, "kept": None, "z": [1, {"b": 2}], **DOZEN}


def test_escaped_field_names_count(spark, customers):
    text = '{"customer_id": 12, "customer\\u005fname": "old"}'
    assert json.loads(enrich(spark, customers, [text])[0])["customer_name"] == "Dozen"
    assert enrich(spark, customers, [text])[0].count("name") == 1


def test_only_hot_keys_are_salted(spark, customers):
    texts = [f'{{"customer_id": 12, "n": {n}}}' for n in range(30)]
    texts += ['{"customer_id": 3}', '{"customer_id": 99}', "{bad"]
    sizing = {"broadcast_rows": 0, "salts": 4, "hot_rows": 10}
    assert enrich(spark, customers, texts, **sizing) == enrich(spark, customers, texts)


def test_null_message_stays_null(spark, customers):
    assert enrich(spark, customers, [None]) == [None]


def test_typed_orders(spark, customers):
    orders = spark.createDataFrame([(1, 12), (2, 99), (3, 4)], "o int, customer_id int")
    for sizing in STRATEGIES[:2]:
        found = {r.o: r for r in lookup.enrich_orders(orders, customers, **sizing).collect()}
        assert found[1].asDict() == {"o": 1, "customer_id": 12, **DOZEN}
        assert found[2].customer_name is None
        assert (found[3].customer_name, found[3].customer_created_at) == ("Four", None)


def test_broadcast_only_when_proven_small(spark, customers):
    assert fits_broadcast(customers, 4) and not fits_broadcast(customers, 3)
    orders = spark.range(10).select(F.col("id").cast("int").alias("customer_id"))
    assert "BroadcastHashJoin" in plan_text(lookup.enrich_orders(orders, customers))


def test_lookup_is_fresh_in_every_batch(spark, folder):
    """Each micro-batch sees the lookup as it is then."""
    table, landed, seen, root = folder(), folder(), [], folder()

    def write_customers(name):
        spark.createDataFrame([(1, name, 30, "a", datetime(2024, 1, 1))], schemas.CUSTOMER) \
            .write.mode("overwrite").parquet(table)

    def collect(batch, batch_id):
        seen.extend(json.loads(row.value)["customer_name"] for row in batch.collect())

    def once():
        stream = spark.readStream.schema("value string").text(landed)
        jobs.order_enrichment(
            stream, lambda: spark.read.schema(schemas.CUSTOMER).parquet(table), collect, root,
            trigger=run.BOUNDED,
        ).awaitTermination()

    for name in ("before", "after"):
        write_customers(name)
        spark.createDataFrame([('{"customer_id": 1}',)], "value string") \
            .write.mode("append").text(landed)
        once()
    assert seen == ["before", "after"]


@pytest.mark.parametrize("sizing", STRATEGIES)
def test_order_of_the_source_survives_every_plan(spark, customers, folder, sizing):
    texts = [(n % 3, n // 3, f'{{"customer_id": {[12, 3, 99][n % 7 % 3]}, "n": {n}}}') for n in range(90)]
    messages = spark.createDataFrame(texts[::-1], "partition int, offset long, value string").repartition(5)
    enriched = lookup.enrich_json(messages, customers, **sizing)
    for one_task in (False, True):
        path = folder()
        lookup.in_source_order(enriched, one_task=one_task).write.parquet(path)
        found = spark.read.parquet(path).select(
            "partition", "offset", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
        ).collect()
        for part in range(3):
            own = sorted((r for r in found if r["partition"] == part), key=lambda r: (r["file"], r["row"]))
            assert [r["offset"] for r in own] == list(range(30))
            assert not one_task or len({r["file"] for r in own}) == 1


def test_ordered_job(spark, customers, folder):
    path, root, seen = folder(), folder(), []
    rows = [(n % 2, n, f'{{"customer_id": 12, "n": {n}}}') for n in range(40)]
    spark.createDataFrame(rows[::-1], "partition int, offset long, value string").write.parquet(path)
    stream = spark.readStream.schema("partition int, offset long, value string").parquet(path)

    def keep(batch, batch_id):
        for part in batch.rdd.glom().collect():
            seen.append([(r["partition"], r["offset"]) for r in part])

    jobs.order_enrichment(
        stream, lambda: customers, keep, root, trigger=run.BOUNDED, ordered=True, broadcast_rows=0, hot_rows=5
    ).awaitTermination()
    found = [place for part in seen for place in part]
    assert sorted(found) == sorted((n % 2, n) for n in range(40))
    for task in seen:
        assert task == sorted(task)
    assert all(sum(any(p == part for p, _ in task) for task in seen) == 1 for part in range(2))


@pytest.mark.parametrize("ids", ["range", "column"])
@pytest.mark.parametrize("sizing", [{}, {"salts": 3}, {"salts": 3, "hot_rows": 5}])
def test_rows_without_a_key_are_spread_over_the_tasks_of_a_shuffled_join(spark, sizing, ids):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in conf}
    left = spark.range(800).select(
        F.col("id").alias("n"), F.when(F.col("id") % 4 == 0, F.col("id") % 40).alias("k")
    )
    known = spark.range(20).select("id", F.concat(F.lit("x"), "id").alias("name"))
    if ids == "column":
        known = known.unionByName(spark.createDataFrame([(None, "nobody")], "id long, name string"))
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        joined = lookup.lookup_join(left, known, "k", "id", broadcast_rows=0, **sizing)
        assert joined.columns == ["n", "k", "id", "name"]
        found = joined.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(r["n"] for r in found) == list(range(800))
    for r in found:
        known_key = r["k"] is not None and r["k"] < 20
        assert (r["id"], r["name"]) == ((r["k"], f"x{r['k']}") if known_key else (None, None))
    tasks = [r["task"] for r in found if r["k"] is None]
    assert len(set(tasks)) == 4 and max(map(tasks.count, set(tasks))) < 300
