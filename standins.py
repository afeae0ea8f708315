"""The given tables, shaped like the inputs of the operators.

Orders stand for price lines and the order feed, customers for the lookup table, and
events for telemetry and drivers. Every row of a table is used, nothing is invented:
columns the operators need are computed from the table's own columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions import keys
from rillflow.session import prepare
from rillflow.sinks import kafka as messages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with its zone-less times read as UTC."""
    df = prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[
        F.col(column).cast("timestamp").alias(column) if kind == "timestamp_ntz" else column
        for column, kind in df.dtypes
    ])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_number(table(spark, sf_dir, "events"))


def with_number(df: DataFrame) -> DataFrame:
    """Events with the number inside ``props`` and a record version."""
    return df.withColumns({
        "k": F.regexp_extract("props", "[0-9]+", 0).cast("int"),
        "version": keys.record_version(F.col("event_id") % 3, F.floor(F.col("event_id") / 3)),
    })


def identity(session: str = "month") -> list:
    """Identity columns of an event taken as telemetry."""
    sessions = {"month": F.month("ts"), "day": F.dayofyear("ts")}
    return [
        F.col("ts").alias("date"),
        F.year("ts").cast("long").alias("meeting_key"),
        sessions[session].cast("long").alias("session_key"),
        F.col("user_id").alias("driver_number"),
    ]


def car_data(df: DataFrame, session: str = "month") -> DataFrame:
    return df.filter("event_type = 'click'").select(
        *identity(session),
        F.floor("value").cast("int").alias("speed"),
        (F.col("k") % 9).cast("short").alias("n_gear"),
        (F.col("k") * 100).alias("rpm"),
        F.col("k").alias("throttle"),
        (100 - F.col("k")).alias("brake"),
        "version",
        F.col("event_id").alias("arrival"),
    )


def location(df: DataFrame, session: str = "month") -> DataFrame:
    return df.filter("event_type = 'view'").select(
        *identity(session),
        (F.floor("value") - 100).cast("int").alias("x"),
        (F.col("k") - 50).alias("y"),
        (-F.col("k")).alias("z"),
        "version",
        F.col("event_id").alias("arrival"),
    )


def position(df: DataFrame, session: str = "month") -> DataFrame:
    return df.filter("event_type = 'purchase'").select(
        *identity(session),
        (F.col("k") % 20 + 1).cast("short").alias("position"),
        "version",
        F.col("event_id").alias("arrival"),
    )


def drivers(df: DataFrame, session: str = "month") -> DataFrame:
    return df.filter("event_type = 'signup'").select(
        *identity(session)[1:],
        F.concat(F.lit("driver "), "user_id", F.lit(" v"), "event_id").alias("full_name"),
        F.concat(F.lit("D"), "user_id").alias("name_acronym"),
        F.concat(F.lit("team "), "k").alias("team_name"),
        F.col("props").alias("headshot_url"),
        F.col("event_id").alias("arrival"),
    )


TELEMETRY = {"car_data": car_data, "location": location, "position": position}


def price_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as price lines.

    Orders of status P carry a decimal where the volume belongs, with the volume after
    it. A header line stands before each urgent order.
    """
    orders = table(spark, sf_dir, "orders")
    volume = F.when(
        F.col("o_orderstatus") == "P", F.concat_ws(",", F.lit("1.5"), "o_custkey")
    ).otherwise(F.col("o_custkey").cast("string"))
    price = F.col("o_totalprice")
    line = F.concat_ws(
        ",", F.date_format("o_orderdate", "yyyy-MM-dd"), price, price + 1, price - 1, price, volume
    )
    header = F.lit("Date,Open,High,Low,Close,Volume")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    lines = F.when(urgent, F.array(header, line)).otherwise(F.array(line))
    return orders.select("o_orderkey", F.explode(lines).alias("value"))


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as price lines of which those of low priority have no readable price."""
    price = F.when(F.col("o_orderpriority") == "5-LOW", "x").otherwise("1.5")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        F.concat_ws(
            ",", day, price, F.lit("2"), F.lit("1"), "o_orderkey", "o_custkey"
        ).alias("value")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as the lookup, under ids moved by 50, so that some orders find none.

    Machinery customers lack a creation time.
    """
    created = F.timestamp_micros(
        F.lit(1_577_836_800_000_000) + F.col("c_custkey") * F.lit(1_234_567)
    )
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 50).cast("int").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("age"),
        F.col("c_mktsegment").alias("address"),
        F.when(F.col("c_mktsegment") != "MACHINERY", created).alias("created_at"),
    )


def order_messages(orders: DataFrame) -> DataFrame:
    """Orders as JSON messages, with the forms a feed may take by priority.

    1: broken JSON; 2: an older customer name to replace; 3: decimal id; 4: id as text;
    5: plain. Orders of status O lack the customer id.
    """
    customer = F.col("o_custkey").cast("string")
    priority = F.substring("o_orderpriority", 1, 1)
    customer_id = (
        F.when(priority == "3", F.concat(customer, F.lit(".7")))
        .when(priority == "4", F.concat(F.lit('"'), customer, F.lit('"')))
        .otherwise(customer)
    )
    id_field = F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(
        F.concat(F.lit(', "customer_id": '), customer_id)
    )
    old_name = F.when(priority == "2", F.lit(', "customer_name": "old"')).otherwise(F.lit(""))
    closing = F.when(priority == "1", F.lit("")).otherwise(F.lit("}"))
    return orders.select(
        F.col("o_orderkey").alias("message_key"),
        F.concat(
            F.lit('{"order_id": '), F.col("o_orderkey").cast("string"), id_field, old_name,
            F.lit(', "status": "'), "o_orderstatus", F.lit('"'), closing,
        ).alias("value"),
    )


def record_forms(df: DataFrame) -> DataFrame:
    """Events as position records in the forms a feed may take, by event.

    1: driver as text; 2: position with a fraction; 3: no position; 4: blank; 5: text after the
    object; 6: two positions, of which the last is right; 7: a word as position; 8: an unknown
    field; 0: plain.
    """
    form = F.col("event_id") % 9
    driver, position = F.col("user_id").cast("string"), (F.col("k") % 20 + 1).cast("string")
    driver = F.when(form == 1, F.concat(F.lit('"'), driver, F.lit('"'))).otherwise(driver)
    field = F.concat(F.lit(', "position": '), position)
    field = (
        F.when(form == 2, F.concat(field, F.lit(".75")))
        .when(form == 3, "")
        .when(form == 6, F.concat(F.lit(', "position": 99'), field))
        .when(form == 7, ', "position": "third"')
        .when(form == 8, F.concat(field, F.lit(', "note": {"position": 98}')))
        .otherwise(field)
    )
    tail = F.when(form == 5, "} and more").otherwise("}")
    record = F.concat(
        F.lit('{"driver_number": '), driver, field, F.lit(', "version": '), "version", tail
    )
    return df.select("event_id", F.when(form == 4, "  ").otherwise(record).alias("value"))


def kafka_rows(feed: DataFrame) -> DataFrame:
    """A feed as the rows of its Kafka topic; arrival gives partition and offset."""
    return feed.select(
        messages.json_message(feed.drop("version")).cast("binary").alias("value"),
        (F.col("arrival") % 3).cast("int").alias("partition"),
        F.floor(F.col("arrival") / 3).alias("offset"),
        F.timestamp_seconds("arrival").alias("timestamp"),
    )
