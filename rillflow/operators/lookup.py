"""Enrichment of order events from a customer lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow import schemas
from rillflow.functions import payloads, times
from rillflow.plans.blocks import hot_keys
from rillflow.plans.sizing import BROADCAST_ROWS, fits_broadcast

# Rows of one key in one join input from which a key counts as hot.
HOT_ROWS = 1_000_000


def _customer_columns(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("id").alias("_id"),
        F.col("name").alias("customer_name"),
        F.col("age").cast("string").alias("customer_age"),
        F.col("address").alias("customer_address"),
        times.trimmed_fraction(F.col("created_at")).alias("customer_created_at"),
    )


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    left_key: str,
    key: str,
    salts: int = 1,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join to a lookup with at most one row per key.

    A lookup proven small is broadcast, and the left side stays where it is. A larger
    one is shuffled. Rows without a key match nothing, so a hash of the whole left row spreads
    them over all tasks. Adaptive execution splits the rows of a hot key. Streaming
    micro-batches run without it: with ``salts``, keys above ``hot_rows`` rows are
    spread over that many tasks by the same hash, and only their lookup
    rows are copied. Keep the record version among the left columns where rows repeat.
    """
    on = F.col(left_key) == F.col(key)
    if fits_broadcast(lookup, broadcast_rows):
        return left.join(F.broadcast(lookup), on, "left")
    spread, one = F.xxhash64(*left.columns), F.array(F.lit(0).cast("long"))
    keyless = F.col(left_key).isNull()
    hot = None
    if salts > 1:
        hot = hot_keys(left.filter(~keyless), [left_key], hot_rows)
    if hot is None:
        salted = left.withColumn("_salt", F.when(keyless, spread).otherwise(0))
        # Exploded, as a plain 0 would be folded into the condition: the salt must stay a join
        # key, or all rows without a key meet in one task.
        copies = lookup.withColumn("_copy", F.explode(one))
    else:
        marks = hot.select(F.col(left_key).alias("_hot_key"))
        salted = (
            left.join(marks, F.col(left_key) == F.col("_hot_key"), "left")
            .withColumn("_salt", F.when(keyless, spread).when(
                F.col("_hot_key").isNotNull(), F.pmod(spread, F.lit(salts))
            ).otherwise(0))
            .drop("_hot_key")
        )
        all_salts = F.array(*[F.lit(salt).cast("long") for salt in range(salts)])
        copies = (
            lookup.join(marks, F.col(key) == F.col("_hot_key"), "left")
            .withColumn("_copies", F.when(F.col("_hot_key").isNotNull(), all_salts).otherwise(one))
            .withColumn("_copy", F.explode("_copies"))
            .drop("_hot_key", "_copies")
        )
    joined = salted.join(copies, on & (F.col("_salt") == F.col("_copy")), "left")
    return joined.drop("_salt", "_copy")


def enrich_orders(
    orders: DataFrame, customers: DataFrame, customer_id: str = "customer_id", **sizing
) -> DataFrame:
    """Order columns plus four customer columns, null where there is no such customer."""
    found = lookup_join(
        orders, _customer_columns(customers), customer_id, "_id", **sizing
    )
    return found.drop("_id")


def enrich_json(
    messages: DataFrame, customers: DataFrame, value: str = "value", **sizing
) -> DataFrame:
    """JSON messages with the four customer fields merged into ``value``.

    Unknown customers give four JSON nulls. Messages that are no JSON object, lack
    ``customer_id``, or match a customer without a creation time pass unchanged. A broadcast
    lookup leaves the rows where they are; other joins move them, and :func:`in_source_order`
    brings them back into the order of a source that numbers its rows.
    """
    # Each message is parsed once, and only what the merge needs goes through the join.
    parsed = messages.withColumn("_document", F.try_parse_json(value))
    document = F.col("_document")
    keyed = parsed.select(
        *messages.columns,
        F.when(
            payloads.has_field(document, "customer_id"),
            payloads.int_field(document, "customer_id"),
        ).alias("_customer"),
        payloads.without_fields(F.col(value), document, schemas.CUSTOMER_FIELDS).alias("_cleared"),
    )
    found = lookup_join(keyed, _customer_columns(customers), "_customer", "_id", **sizing)
    merged = payloads.close_with(
        payloads.opened(F.coalesce("_cleared", value)), F.struct(*schemas.CUSTOMER_FIELDS)
    )
    complete = F.col("_id").isNull() | F.col("customer_created_at").isNotNull()
    result = F.when(F.col("_customer").isNotNull() & complete, merged).otherwise(F.col(value))
    return found.withColumn(value, result).select(*messages.columns)


def in_source_order(
    rows: DataFrame, partition: str = "partition", offset: str = "offset", one_task: bool = False
) -> DataFrame:
    """Rows in the order in which each partition of their source held them, after any join.

    Tasks take ranges of (partition, offset), so files written in the order of their tasks hold
    every source partition in order, and a hot one is spread over neighbouring tasks. A sink
    whose tasks write side by side, such as a topic, needs ``one_task`` per source partition,
    which is how many read it.
    """
    dealt = rows.repartition(partition) if one_task else rows.repartitionByRange(partition, offset)
    return dealt.sortWithinPartitions(partition, offset)
