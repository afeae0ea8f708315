"""Registered queries and, next to each, the SQL that must give the same rows.

All of them read whole tables. Averages are rounded on both sides, because the order of
a floating-point sum differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import standins
from rillflow import schemas
from rillflow.functions import keys as key_functions
from rillflow.functions import payloads, times
from rillflow.operators import averages, dashboard, lookup, merge, prices, reference, versions
from rillflow.plans import jobs
from rillflow.session import scratch_path
from rillflow.sinks import files, kafka, serving, settled
from rillflow.sources import files as source_files
from rillflow.sources import lookup as lookup_source
from rillflow.streaming import averages as stream_averages
from rillflow.streaming import run
from rillflow.streaming.reference_tables import ReferenceJoin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SIX_HOURS = 6 * 3600.0

# Events with the columns of standins.with_number and standins.identity.
EVENTS = """ev AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
    (event_id % 3) * 1000000000000 + event_id // 3 AS version,
    CAST(year(ts) AS BIGINT) AS meeting_key, CAST(month(ts) AS BIGINT) AS session_key,
    user_id AS driver_number, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS date
  FROM events)"""
CAR = """CAST(floor(value) AS INTEGER) AS speed, CAST(k % 9 AS SMALLINT) AS n_gear,
    k * 100 AS rpm, k AS throttle, 100 - k AS brake"""
LOCATION = "CAST(floor(value) AS INTEGER) - 100 AS x, k - 50 AS y, -k AS z"
POSITION = "CAST(k % 20 + 1 AS SMALLINT) AS position"
DRIVER = """'driver ' || user_id || ' v' || event_id AS full_name,
    'D' || user_id AS name_acronym, 'team ' || k AS team_name, props AS headshot_url"""


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle:
            ORACLES[name] = oracle
        return query

    return add


def micros_text(df: DataFrame, column: str = "date") -> DataFrame:
    """Times as text, so that both engines compare the same thing."""
    return df.withColumn(column, F.date_format(column, MICROS))


def rounded(df: DataFrame, column: str = "average") -> DataFrame:
    """Averages to four places, moved off the ties first.

    Averages of whole cents often end in an exact 5, where the last place would hang on
    the order of the sum.
    """
    return df.withColumn(column, F.round(F.col(column) + F.lit(0.00000137), 4))


# Prices and averages ----------------------------------------------------------------

def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standins.table(spark, sf_dir, "orders")
    return orders.withColumn("month", times.month_start(F.to_date("o_orderdate")))


@register("month_average", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS date,
  round(avg(o_totalprice) + 0.00000137, 4) AS average
FROM orders GROUP BY 1""")
def month_average(spark, sf_dir):
    totals = averages.total_average(monthly_orders(spark, sf_dir), ["month"], "o_totalprice")
    return rounded(prices.month_record(totals))


@register("month_partial_sums", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month,
  count(o_totalprice) AS count, round(sum(o_totalprice), 2) AS sum
FROM orders GROUP BY 1""")
def month_partial_sums(spark, sf_dir):
    sums = averages.partial_sums(monthly_orders(spark, sf_dir), ["month"], "o_totalprice")
    return sums.withColumn("sum", F.round("sum", 2))


@register("running_month_average", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, o_orderkey,
  round(avg(o_totalprice) OVER (PARTITION BY date_trunc('month', o_orderdate)
    ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) + 0.00000137, 4) AS average
FROM orders""")
def running_month_average(spark, sf_dir):
    running = averages.running_average(
        monthly_orders(spark, sf_dir), ["month"], "o_totalprice", "o_orderkey"
    )
    return rounded(running.select("month", "o_orderkey", "average"))


@register("running_month_average_blocks", ORACLES["running_month_average"])
def running_month_average_blocks(spark, sf_dir):
    """The same with every month over 150 rows cut into blocks."""
    running = averages.running_average(
        monthly_orders(spark, sf_dir), ["month"], "o_totalprice", "o_orderkey", block_rows=150
    )
    return rounded(running.select("month", "o_orderkey", "average"))


@register("year_buckets", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS date,
  round(avg(o_totalprice) + 0.00000137, 4) AS average, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders GROUP BY date_trunc('month', o_orderdate), year(o_orderdate)""")
def year_buckets(spark, sf_dir):
    path = scratch_path(spark, "year-buckets")
    totals = averages.total_average(monthly_orders(spark, sf_dir), ["month"], "o_totalprice")
    files.write_by_year(prices.month_record(totals), path)
    return rounded(spark.read.schema("date string, average double, year int").parquet(path))


@register("price_lines", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS open,
  o_totalprice + 1 AS high, o_totalprice - 1 AS low, o_totalprice AS close,
  CAST(o_custkey AS INTEGER) AS volume
FROM orders""")
def price_lines(spark, sf_dir):
    return prices.parse_prices(standins.price_lines(spark, sf_dir), keep=["o_orderkey"])


@register("price_lines_diverted", """
SELECT concat_ws(',', strftime(o_orderdate, '%Y-%m-%d'), 'x', '2', '1', o_orderkey, o_custkey)
  AS value
FROM orders WHERE o_orderpriority = '5-LOW'""")
def price_lines_diverted(spark, sf_dir):
    return prices.divert_prices(standins.broken_lines(spark, sf_dir))[1]


@register("stock_running_job", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, o_orderkey,
  round(avg(o_totalprice) OVER (PARTITION BY date_trunc('month', o_orderdate)
    ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) + 0.00000137, 4) AS average
FROM orders""")
def stock_running_job(spark, sf_dir):
    lines = standins.price_lines(spark, sf_dir)
    return rounded(jobs.running_month_averages(lines, "o_orderkey"))


@register("stock_total_job", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS date,
  round(avg(o_totalprice) + 0.00000137, 4) AS average, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders GROUP BY date_trunc('month', o_orderdate), year(o_orderdate)""")
def stock_total_job(spark, sf_dir):
    path = scratch_path(spark, "stock-averages")
    jobs.stock_averages(standins.price_lines(spark, sf_dir), path)
    return rounded(spark.read.schema("date string, average double, year int").parquet(path))


@register("stock_text_job", ORACLES["stock_total_job"])
def stock_text_job(spark, sf_dir):
    """The same from a folder of text files."""
    source, path = scratch_path(spark, "stock-lines"), scratch_path(spark, "stock-averages")
    standins.price_lines(spark, sf_dir).select("value").write.text(source)
    jobs.stock_averages(source_files.text_lines(spark, source), path)
    return rounded(spark.read.schema("date string, average double, year int").parquet(path))


@register("inactivity_average", """
WITH run AS (
  SELECT user_id, ts, lead(ts) OVER w AS following,
    avg(value) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS average
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
  round(average + 0.00000137, 4) AS average
FROM run WHERE following IS NULL OR following - ts > INTERVAL 6 HOUR""")
def inactivity_average(spark, sf_dir):
    events = standins.table(spark, sf_dir, "events")
    return rounded(micros_text(
        averages.inactivity_average(events, ["user_id"], "value", "ts", SIX_HOURS), "ts"
    ))


@register("inactivity_average_blocks", ORACLES["inactivity_average"])
def inactivity_average_blocks(spark, sf_dir):
    """The same with hot users cut into blocks."""
    events = standins.table(spark, sf_dir, "events")
    return rounded(micros_text(averages.inactivity_average(
        events, ["user_id"], "value", "ts", SIX_HOURS, block_rows=20
    ), "ts"))


# Order enrichment -------------------------------------------------------------------

# DuckDB form of standins.customers.
CUSTOMERS = """cust AS (
  SELECT c_custkey + 50 AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS age,
    c_mktsegment AS address, CASE WHEN c_mktsegment <> 'MACHINERY' THEN
      regexp_replace(strftime(make_timestamp(1577836800000000 + c_custkey * 1234567),
        '%Y-%m-%d %H:%M:%S.%f'), '0{1,5}$', '') END AS created_at
  FROM customer)"""


@register("lookup_enrich", f"""
WITH {CUSTOMERS}
SELECT o_orderkey, o_totalprice, name AS customer_name, age AS customer_age,
  address AS customer_address, created_at AS customer_created_at
FROM orders LEFT JOIN cust ON o_custkey = id""")
def lookup_enrich(spark, sf_dir):
    orders = standins.table(spark, sf_dir, "orders")
    enriched = lookup.enrich_orders(orders, standins.customers(spark, sf_dir), "o_custkey")
    return enriched.select("o_orderkey", "o_totalprice", *schemas.CUSTOMER_FIELDS)


@register("lookup_enrich_salted", ORACLES["lookup_enrich"])
def lookup_enrich_salted(spark, sf_dir):
    """The same with a lookup too large to broadcast and customers of many orders spread."""
    orders = standins.table(spark, sf_dir, "orders")
    enriched = lookup.enrich_orders(
        orders, standins.customers(spark, sf_dir), "o_custkey",
        salts=4, hot_rows=15, broadcast_rows=0,
    )
    return enriched.select("o_orderkey", "o_totalprice", *schemas.CUSTOMER_FIELDS)


@register("lookup_enrich_parquet", ORACLES["lookup_enrich"])
def lookup_enrich_parquet(spark, sf_dir):
    """The same with the lookup kept as Parquet."""
    path = scratch_path(spark, "customers")
    standins.customers(spark, sf_dir).write.parquet(path)
    orders = standins.table(spark, sf_dir, "orders")
    enriched = lookup.enrich_orders(orders, lookup_source.parquet_lookup(spark, path), "o_custkey")
    return enriched.select("o_orderkey", "o_totalprice", *schemas.CUSTOMER_FIELDS)


LOOKUP_JSON = f"""
WITH {CUSTOMERS}, msg AS (
  SELECT *, substr(o_orderpriority, 1, 1) AS form,
    o_orderstatus <> 'O' AND substr(o_orderpriority, 1, 1) <> '1' AS readable
  FROM orders),
found AS (
  SELECT msg.*, cust.*, readable AND (id IS NULL OR created_at IS NOT NULL) AS merged
  FROM msg LEFT JOIN cust ON readable AND o_custkey = id)
SELECT o_orderkey AS message_key, NOT merged AS unchanged,
  CASE WHEN form <> '1' THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
  CASE WHEN form <> '1' THEN o_orderstatus END AS status,
  CASE WHEN merged THEN name WHEN form = '2' THEN 'old' END AS customer_name,
  CASE WHEN merged THEN age END AS customer_age,
  CASE WHEN merged THEN address END AS customer_address,
  CASE WHEN merged THEN created_at END AS customer_created_at
FROM found"""

MESSAGE = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("status", T.StringType()),
    *[T.StructField(name, T.StringType()) for name in schemas.CUSTOMER_FIELDS],
])


def read_back(enriched: DataFrame) -> DataFrame:
    """Enriched messages as columns; ``original`` holds each message as it came in."""
    closed = F.col("value").endswith("}")
    record = F.when(closed, F.from_json("value", MESSAGE)).alias("record")
    return enriched.select(
        "message_key", (F.col("value") == F.col("original")).alias("unchanged"), record
    ).select("message_key", "unchanged", "record.*")


@register("lookup_enrich_json", LOOKUP_JSON)
def lookup_enrich_json(spark, sf_dir):
    messages = standins.order_messages(standins.table(spark, sf_dir, "orders"))
    messages = messages.withColumn("original", F.col("value"))
    return read_back(lookup.enrich_json(messages, standins.customers(spark, sf_dir)))


@register("lookup_enrich_ordered", f"""
WITH {CUSTOMERS}
SELECT o_orderkey AS message_key, CAST(o_orderkey % 3 AS INTEGER) AS partition,
  row_number() OVER (PARTITION BY o_orderkey % 3 ORDER BY o_orderkey // 3, o_orderkey) AS position,
  CASE WHEN o_orderstatus <> 'O' AND substr(o_orderpriority, 1, 1) <> '1'
      AND (id IS NULL OR created_at IS NOT NULL) THEN name
    WHEN substr(o_orderpriority, 1, 1) = '2' THEN 'old' END AS customer_name
FROM orders LEFT JOIN cust ON o_custkey = id""")
def lookup_enrich_ordered(spark, sf_dir):
    """Messages of three source partitions through the salted join, written in their order.

    ``position`` is the place of a message among those of its partition in the written files.
    """
    path = scratch_path(spark, "enriched-in-order")
    orders = standins.table(spark, sf_dir, "orders")
    messages = standins.order_messages(orders).withColumns({
        "partition": (F.col("message_key") % 3).cast("int"), "offset": F.floor(F.col("message_key") / 3),
    })
    enriched = lookup.enrich_json(
        messages, standins.customers(spark, sf_dir), salts=4, hot_rows=15, broadcast_rows=0
    )
    lookup.in_source_order(enriched).write.parquet(path)
    files_of = Window.partitionBy("partition").orderBy("file", "row")
    return spark.read.schema(messages.schema).parquet(path).select(
        "message_key", "partition", F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        F.when(F.col("value").endswith("}"), F.get_json_object("value", "$.customer_name")).alias("customer_name"),
    ).select(
        "message_key", "partition", F.row_number().over(files_of).cast("long").alias("position"),
        "customer_name",
    )


# Reference join ---------------------------------------------------------------------

def reference_oracle(event_type: str, measures: str) -> str:
    names = [part.split(" AS ")[-1].strip() for part in measures.replace("\n", " ").split(", ")]
    columns = ", ".join(name for name in names if name.isidentifier())
    return f"""
WITH {EVENTS}, drv AS (SELECT event_id AS driver_id, {DRIVER} FROM ev
  WHERE event_type = 'signup'),
known AS (
  SELECT *, {measures},
    last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (
      PARTITION BY meeting_key, session_key, driver_number ORDER BY event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before_id,
    first_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (
      PARTITION BY meeting_key, session_key, driver_number ORDER BY event_id
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after_id
  FROM ev WHERE event_type IN ('signup', '{event_type}'))
SELECT date, meeting_key, session_key, driver_number, {columns}, version,
  event_id AS arrival, full_name, name_acronym, team_name, headshot_url,
  before_id IS NULL AS held
FROM known JOIN drv ON driver_id = coalesce(before_id, after_id)
WHERE event_type = '{event_type}'"""


def pending_join(spark: SparkSession, sf_dir: str, feed: str, **strategy) -> DataFrame:
    events = standins.events(spark, sf_dir)
    joined = reference.reference_join(
        standins.TELEMETRY[feed](events), standins.drivers(events), held="held", **strategy
    )
    return micros_text(joined)


@register("pending_join_car", reference_oracle("click", CAR))
def pending_join_car(spark, sf_dir):
    return pending_join(spark, sf_dir, "car_data")


@register("pending_join_location", reference_oracle("view", LOCATION))
def pending_join_location(spark, sf_dir):
    return pending_join(spark, sf_dir, "location")


@register("pending_join_position", reference_oracle("purchase", POSITION))
def pending_join_position(spark, sf_dir):
    return pending_join(spark, sf_dir, "position")


@register("pending_join_scan", reference_oracle("click", CAR))
def pending_join_scan(spark, sf_dir):
    """The plan for reference tables too large to broadcast."""
    return pending_join(spark, sf_dir, "car_data", broadcast_rows=0)


@register("pending_join_blocks", reference_oracle("click", CAR))
def pending_join_blocks(spark, sf_dir):
    """The ordered plan with hot keys cut into blocks."""
    return pending_join(spark, sf_dir, "car_data", broadcast_rows=0, block_rows=40)


@register("pending_join_ties", f"""
WITH {EVENTS}, arr AS (SELECT *, event_id // 4000 AS arrival FROM ev),
drv AS (SELECT meeting_key AS m, session_key AS s, driver_number AS d, arrival AS since,
    max({{'n': 'driver ' || user_id || ' v' || event_id, 't': 'team ' || k}}) AS record
  FROM arr WHERE event_type = 'signup' GROUP BY ALL),
pick AS (SELECT event_id, arrival, max(since) FILTER (since <= arrival) AS last_at, min(since) AS first_at,
    any_value(m) AS m, any_value(s) AS s, any_value(d) AS d
  FROM arr JOIN drv ON m = meeting_key AND s = session_key AND d = driver_number
  WHERE event_type = 'click' GROUP BY ALL)
SELECT event_id, arrival, record.n AS full_name, record.t AS team_name, last_at IS NULL AS held
FROM pick JOIN drv USING (m, s, d) WHERE since = coalesce(last_at, first_at)""")
def pending_join_ties(spark, sf_dir):
    """Thousands of rows that arrive at once, cut into blocks in spite of it."""
    events = standins.events(spark, sf_dir)
    at = F.floor(F.col("arrival") / 4000)
    telemetry = standins.car_data(events).withColumn("event_id", F.col("arrival")).withColumn("arrival", at)
    joined = reference.reference_join(
        telemetry, standins.drivers(events).withColumn("arrival", at),
        columns=["full_name", "team_name"], held="held", broadcast_rows=0, block_rows=10,
    )
    return joined.select("event_id", "arrival", "full_name", "team_name", "held")


UNDATED = f"""
WITH {EVENTS}, drv AS (SELECT event_id AS driver_id, {DRIVER} FROM ev
  WHERE event_type = 'signup'),
known AS (
  SELECT *, {CAR}, event_id % 7 <> 0 AS dated,
    last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (
      PARTITION BY meeting_key, session_key, driver_number ORDER BY event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before_id,
    min(CASE WHEN event_type = 'signup' THEN event_id END) OVER (
      PARTITION BY meeting_key, session_key, driver_number) AS first_id
  FROM ev WHERE event_type IN ('signup', 'click'))
SELECT event_id, full_name, NOT dated OR before_id IS NULL AS held
FROM known JOIN drv ON driver_id = CASE WHEN dated THEN coalesce(before_id, first_id)
  ELSE first_id END
WHERE event_type = 'click'"""


def pending_undated(spark: SparkSession, sf_dir: str, **strategy) -> DataFrame:
    """Telemetry of which a seventh has no arrival: it counts as before everything."""
    events = standins.events(spark, sf_dir)
    telemetry = standins.car_data(events).select(
        "meeting_key", "session_key", "driver_number", F.col("arrival").alias("event_id"),
        F.when(F.col("arrival") % 7 != 0, F.col("arrival")).alias("arrival"),
    )
    joined = reference.reference_join(telemetry, standins.drivers(events), held="held", **strategy)
    return joined.select("event_id", "full_name", "held")


@register("pending_join_undated", UNDATED)
def pending_join_undated(spark, sf_dir):
    return pending_undated(spark, sf_dir)


@register("pending_join_undated_scan", UNDATED)
def pending_join_undated_scan(spark, sf_dir):
    return pending_undated(spark, sf_dir, broadcast_rows=0)


@register("pending_rows", f"""
WITH {EVENTS}
SELECT dayofyear(ts) AS session_key, driver_number, event_id AS arrival FROM ev AS c
WHERE event_type = 'click' AND NOT EXISTS (
  SELECT 1 FROM ev AS s WHERE s.event_type = 'signup' AND s.user_id = c.user_id
    AND s.meeting_key = c.meeting_key AND dayofyear(s.ts) = dayofyear(c.ts))""")
def pending_rows(spark, sf_dir):
    events = standins.events(spark, sf_dir)
    waiting = reference.rows_waiting(
        standins.car_data(events, "day"), standins.drivers(events, "day")
    )
    return waiting.select("session_key", "driver_number", "arrival")


@register("session_slice", f"""
WITH {EVENTS}
SELECT dayofyear(ts) AS session_key, driver_number, event_id AS arrival FROM ev AS c
WHERE event_type = 'view' AND EXISTS (
  SELECT 1 FROM ev AS s WHERE s.event_type = 'signup' AND s.user_id = c.user_id
    AND dayofyear(s.ts) = dayofyear(c.ts))""")
def session_slice(spark, sf_dir):
    events = standins.events(spark, sf_dir)
    dated = reference.with_event_date(standins.location(events, "day"))
    found = reference.of_known_drivers(dated, standins.drivers(events, "day"))
    return found.select("session_key", "driver_number", "arrival")


@register("one_session", f"""
WITH {EVENTS}
SELECT driver_number, event_id AS arrival, {POSITION} FROM ev
WHERE event_type = 'purchase' AND meeting_key = 2024 AND session_key = 1""")
def one_session(spark, sf_dir):
    positions = standins.position(standins.events(spark, sf_dir))
    return reference.of_session(positions, 1, 2024).select("driver_number", "arrival", "position")


# Versions and latest values ---------------------------------------------------------

@register("record_version", """
SELECT event_id, (event_id % 3) * 1000000000000 + event_id // 3 AS version,
  year(ts) || '|' || month(ts) || '|' || user_id AS join_key
FROM events""")
def record_version(spark, sf_dir):
    events = standins.events(spark, sf_dir)
    key = key_functions.join_key(F.year("ts"), F.month("ts"), F.col("user_id"))
    return events.select("event_id", "version", key.alias("join_key"))


NEWEST = f"""
WITH {EVENTS}, daily AS (
  SELECT *, row_number() OVER (
    PARTITION BY meeting_key, session_key, driver_number, date_trunc('day', ts)
    ORDER BY version DESC) AS place
  FROM ev)
SELECT meeting_key, session_key, driver_number, strftime(ts, '%Y-%m-%d') AS date,
  event_id, value, version
FROM daily WHERE place = 1"""


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the day as their event time, so that many share a serving key."""
    events = standins.events(spark, sf_dir).withColumn("ts", F.date_trunc("day", "ts"))
    return events.select(*standins.identity(), "event_id", "value", "version")


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@register("newest_version", NEWEST)
def newest_version(spark, sf_dir):
    return with_day(versions.newest_version(daily_events(spark, sf_dir)))


@register("newest_version_ranked", NEWEST)
def newest_version_ranked(spark, sf_dir):
    return with_day(versions.newest_version_ranked(daily_events(spark, sf_dir)))


@register("consistent_read", NEWEST)
def consistent_read(spark, sf_dir):
    """The same after a replay that wrote every row twice."""
    written = daily_events(spark, sf_dir)
    return with_day(versions.consistent_read(written.unionByName(written)))


def latest_oracle(order: str) -> str:
    return f"""
WITH {EVENTS}
SELECT driver_number, arg_max(event_id, {order}) AS event_id, arg_max(value, {order}) AS value,
  arg_max(date, {order}) AS date, arg_max(version, {order}) AS version
FROM ev GROUP BY driver_number"""


def latest_events(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    events = standins.events(spark, sf_dir).withColumnsRenamed(
        {"ts": "date", "user_id": "driver_number"}
    )
    columns = ["event_id", "value", "date", "version"]
    return micros_text(versions.latest_by(events, ["driver_number"], [by], columns))


@register("latest_by_date", latest_oracle("ts"))
def latest_by_date(spark, sf_dir):
    return latest_events(spark, sf_dir, "date")


@register("latest_by_version", latest_oracle("version"))
def latest_by_version(spark, sf_dir):
    return latest_events(spark, sf_dir, "version")


# Dashboard --------------------------------------------------------------------------

def served(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """A telemetry feed with its drivers, as its serving table holds it."""
    events = standins.events(spark, sf_dir)
    joined = reference.reference_join(standins.TELEMETRY[feed](events), standins.drivers(events))
    return reference.enriched_row(joined, feed)


def latest_served_oracle(event_type: str, measures: str, columns: str, tail: str = "") -> str:
    return f"""
WITH served AS ({reference_oracle(event_type, measures)}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY meeting_key, session_key, driver_number
    ORDER BY date DESC, version DESC) AS place FROM served)
SELECT meeting_key, session_key, driver_number, date, version, {columns}, full_name,
  name_acronym, team_name, headshot_url
FROM ranked WHERE place = 1 {tail}"""


@register("current_positions", latest_served_oracle("purchase", POSITION, "position"))
def current_positions(spark, sf_dir):
    return micros_text(dashboard.current_positions(served(spark, sf_dir, "position")))


@register("top_cards", latest_served_oracle(
    "purchase", POSITION, "position",
    "ORDER BY position, meeting_key, session_key, driver_number LIMIT 10"))
def top_cards(spark, sf_dir):
    return micros_text(dashboard.top_cards(served(spark, sf_dir, "position"), 10))


@register("latest_car_data", latest_served_oracle(
    "click", CAR, "speed, n_gear, rpm, throttle, brake"))
def latest_car_data(spark, sf_dir):
    return micros_text(dashboard.latest_car_data(served(spark, sf_dir, "car_data")))


@register("latest_location", latest_served_oracle("view", LOCATION, "x, y, z"))
def latest_location(spark, sf_dir):
    return micros_text(dashboard.latest_location(served(spark, sf_dir, "location")))


def consistent_oracle(event_type: str, measures: str, columns: str, where: str = "TRUE") -> str:
    return f"""
WITH {EVENTS}, stored AS (
  SELECT meeting_key, session_key, driver_number, date_trunc('milliseconds', ts) AS moment, version,
    {measures} FROM ev WHERE event_type = '{event_type}' AND {where}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY meeting_key, session_key, driver_number, moment
    ORDER BY version DESC) AS place FROM stored)
SELECT meeting_key, session_key, driver_number, strftime(moment, '%Y-%m-%d %H:%M:%S.%f') AS date,
  {columns}
FROM ranked WHERE place = 1"""


@register("track_trace", consistent_oracle("view", LOCATION, "x, y"))
def track_trace(spark, sf_dir):
    locations = standins.location(standins.events(spark, sf_dir)).drop("arrival")
    return micros_text(dashboard.track_trace(locations))


@register("telemetry_series", consistent_oracle(
    "click", CAR, "speed, n_gear, rpm, throttle, brake",
    "ts >= (SELECT max(ts) - INTERVAL 7 DAY FROM events WHERE event_type = 'click')"))
def telemetry_series(spark, sf_dir):
    """The last seven days, as a dashboard asks for them."""
    cars = standins.car_data(standins.events(spark, sf_dir)).drop("arrival")
    newest = cars.agg(F.max("date")).scalar()
    return micros_text(
        dashboard.telemetry_series(cars, start=newest - F.expr("INTERVAL 7 DAY"))
    )


# Merging and schedule ---------------------------------------------------------------

@register("event_time_merge", f"""
WITH {EVENTS}, tagged AS (
  SELECT CASE event_type WHEN 'purchase' THEN 'position' WHEN 'view' THEN 'location'
    ELSE 'car_data' END AS topic, event_id AS arrival, date, ts, driver_number,
    CASE WHEN event_type = 'click'
      THEN CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END AS speed,
    CASE WHEN event_type = 'view'
      THEN CAST(CAST(floor(value) AS INTEGER) - 100 AS VARCHAR) END AS x,
    CASE WHEN event_type = 'purchase' THEN CAST(k % 20 + 1 AS VARCHAR) END AS position
  FROM ev WHERE event_type IN ('purchase', 'view', 'click'))
SELECT topic, arrival, date, driver_number, speed, x, position,
  epoch_us(ts) // 1000 AS event_millis,
  round((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM tagged)) / 1e6 / 60 + 0.00000137, 4)
    AS offset_seconds
FROM tagged""")
def event_time_merge(spark, sf_dir):
    events = standins.events(spark, sf_dir)
    merged = merge.tag_and_union({feed: make(events) for feed, make in standins.TELEMETRY.items()})
    ordered = merge.in_event_time(merge.with_schedule(merged, speed=60.0), sequence="arrival")
    return rounded(micros_text(ordered), "offset_seconds").select(
        "topic", "arrival", "date", "driver_number", "event_millis", "offset_seconds",
        *[F.col(name).cast("string").alias(name) for name in ("speed", "x", "position")],
    )


@register("published_messages", f"""
WITH {EVENTS}
SELECT '{{"date":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z","driver_number":'
  || driver_number || ',"position":' || (k % 20 + 1) || '}}' AS value
FROM ev WHERE event_type = 'purchase'""")
def published_messages(spark, sf_dir):
    positions = standins.position(standins.events(spark, sf_dir))
    return kafka.as_messages(positions, ["date", "driver_number", "position"])


@register("timestamp_forms", """
SELECT event_id, CASE WHEN event_type <> 'error'
  THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS parsed FROM events""")
def timestamp_forms(spark, sf_dir):
    events = standins.table(spark, sf_dir, "events")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ahead = F.date_format(F.col("ts") + F.expr("INTERVAL 2 HOURS"), iso)
    form = (
        F.when(F.col("event_type") == "click", F.concat(F.date_format("ts", iso), F.lit("Z")))
        .when(F.col("event_type") == "view", F.concat(F.date_format("ts", iso), F.lit("+00:00")))
        .when(F.col("event_type") == "purchase", F.concat(ahead, F.lit("+02:00")))
        .when(F.col("event_type") == "signup", F.date_format("ts", iso))
        .otherwise(F.lit("  "))
    )
    parsed = events.select("event_id", times.parse_instant(form).alias("parsed"))
    return micros_text(parsed, "parsed")


# Serving tables ---------------------------------------------------------------------

@register("serving_json_rows", f"""
WITH {EVENTS}, car AS (SELECT *, {CAR} FROM ev WHERE event_type = 'click')
SELECT '{{"date":"' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || '","driver_number":'
  || driver_number || ',"session_key":' || session_key || ',"meeting_key":' || meeting_key
  || ',"speed":' || speed || ',"n_gear":' || n_gear || ',"rpm":' || rpm || ',"throttle":'
  || throttle || ',"brake":' || brake || ',"version":' || version || '}}' AS value
FROM car""")
def serving_json_rows(spark, sf_dir):
    cars = standins.car_data(standins.events(spark, sf_dir))
    return cars.select(payloads.json_row("car_data").alias("value"))


@register("json_round_trip", f"""
WITH {EVENTS}
SELECT date, session_key, meeting_key, CAST(driver_number AS INTEGER) AS driver_number,
  {POSITION}, version
FROM ev WHERE event_type = 'purchase'""")
def json_round_trip(spark, sf_dir):
    """Records to JSON with an unknown field, and back by the feed's schema."""
    positions = standins.position(standins.events(spark, sf_dir))
    written = kafka.as_messages(positions.withColumn("note", F.lit("unknown")))
    decoded = payloads.decode(written, schemas.POSITION_FEED)
    return micros_text(decoded.withColumn("date", times.parse_instant(F.col("date"))))


@register("landed_feed", ORACLES["json_round_trip"])
def landed_feed(spark, sf_dir):
    """Records that someone else landed as files of JSON lines."""
    path = scratch_path(spark, "landed-positions")
    kafka.as_messages(standins.position(standins.events(spark, sf_dir))).write.text(path)
    return micros_text(source_files.landed_records(spark, path, "position"))


@register("decode_forms", f"""
WITH {EVENTS}, form AS (SELECT *, event_id % 9 AS form FROM ev)
SELECT event_id, form IN (4, 7) AS diverted,
  CASE WHEN form NOT IN (4, 7) THEN driver_number END AS driver_number,
  CASE WHEN form = 3 THEN 0 WHEN form NOT IN (4, 7) THEN k % 20 + 1 END AS position,
  CASE WHEN form NOT IN (4, 7) THEN version END AS version
FROM form""")
def decode_forms(spark, sf_dir):
    """Records as they may come in: numbers as text or with a fraction, a missing field, blank
    text, text after the object, a field given twice, a word for a number, an unknown field."""
    messages = standins.record_forms(standins.events(spark, sf_dir))
    good, bad = payloads.decode_or_divert(messages, schemas.POSITION_FEED, keep=["event_id"])
    numbers = ("driver_number", "position", "version")
    return good.select("event_id", F.lit(False).alias("diverted"), *numbers).unionByName(
        bad.select("event_id", F.lit(True).alias("diverted")), allowMissingColumns=True
    )


@register("driver_table", f"""
WITH {EVENTS}
SELECT DISTINCT meeting_key, session_key, CAST(driver_number AS INTEGER) AS driver_number,
  {DRIVER} FROM ev WHERE event_type = 'signup'""")
def driver_table(spark, sf_dir):
    """Drivers appended twice, as a replay does, and read without the copies."""
    path = scratch_path(spark, "drivers")
    drivers = standins.drivers(standins.events(spark, sf_dir)).drop("arrival")
    serving.append_path(drivers, "drivers", path)
    serving.append_path(drivers, "drivers", path)
    return serving.read_path(spark, "drivers", path).distinct()


@register("serving_replay", consistent_oracle("view", LOCATION, "version, x, y, z"))
def serving_replay(spark, sf_dir):
    """Enriched rows appended twice to their table; readers see each key once."""
    path = scratch_path(spark, "location")
    rows = served(spark, sf_dir, "location")
    serving.append_path(rows, "location", path)
    serving.append_path(rows, "location", path)
    table = versions.consistent_read(serving.read_path(spark, "location", path))
    return micros_text(table).select(
        "meeting_key", "session_key", F.col("driver_number").cast("long").alias("driver_number"),
        "date", "version", "x", "y", "z",
    )


@register("catalog_tables", ORACLES["driver_table"])
def catalog_tables(spark, sf_dir):
    """Drivers appended twice to the table of a catalog that is created twice, as restarts do."""
    path = scratch_path(spark, "catalog")
    database = f"race_{path.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    drivers = standins.drivers(standins.events(spark, sf_dir)).drop("arrival")
    for _ in range(2):
        serving.create_tables(spark, database, path)
        serving.append(drivers, "drivers", database)
    for table in schemas.SERVING:
        serving.check_table(spark, table, database)
    return spark.table(f"{database}.drivers").distinct()


@register("consistent_read_incremental", ORACLES["serving_replay"])
def consistent_read_incremental(spark, sf_dir):
    """A table whose older months were merged twice, between appends that reach back into them."""
    path, settled_path = scratch_path(spark, "location"), scratch_path(spark, "location-settled")
    rows = served(spark, sf_dir, "location")
    parts = [rows.filter(F.col("version") % 3 == part) for part in range(3)]
    serving.append_path(parts[0].unionByName(parts[1]), "location", path)
    settled.settle(spark, "location", path, settled_path, lambda at: at["session_key"] <= 8)
    serving.append_path(parts[2].filter("session_key <= 4").unionByName(parts[0]), "location", path)
    settled.settle(spark, "location", path, settled_path, lambda at: at["session_key"] <= 6)
    serving.append_path(parts[2].filter("session_key > 4"), "location", path)
    table = settled.consistent_read_incremental(spark, "location", path, settled_path)
    return micros_text(table).select(
        "meeting_key", "session_key", F.col("driver_number").cast("long").alias("driver_number"),
        "date", "version", "x", "y", "z",
    )


# Streams ----------------------------------------------------------------------------

def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of files, with zone-less times read as UTC."""
    schema = standins.table(spark, sf_dir, name).schema
    stored = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    stream = (
        spark.readStream.schema(stored).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    )
    return stream.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def bounded_run(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there now and read what it wrote."""
    root = scratch_path(spark, name)
    with run.state_per_core(spark):
        query = run.start_parquet(df, name, f"{root}/checkpoint", f"{root}/rows", run.BOUNDED)
        query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/rows")


# Rows of a landed file, about: what one task of a micro-batch reads.
FILE_ROWS = 250_000


def landed(
    spark: SparkSession, sf_dir: str, root: str, parts: int, file_rows: int = FILE_ROWS
) -> DataFrame:
    """All events as a stream of ``parts`` micro-batches, cut along their ids.

    Each part has the same number of files, empty ones among them if need be, and a batch takes
    that many, in the order in which they were written.
    """
    events = standins.table(spark, sf_dir, "events")
    top, rows = events.agg(F.max("event_id") + 1, F.count("*")).first()
    top, files_each = top or 1, max(1, -(-rows // (parts * file_rows)))
    path, empty = f"{root}/events", spark.createDataFrame([], events.schema).coalesce(1)
    for part in range(parts):
        chosen = events.filter(F.floor(F.col("event_id") * parts / top) == part)
        chosen.repartition(files_each).write.mode("append").parquet(path)
        there = len(spark.read.schema(events.schema).parquet(path).inputFiles())
        for _ in range((part + 1) * files_each - there):
            empty.write.mode("append").parquet(path)
    return (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files_each).parquet(path)
    )


def batch_rows(root: str) -> Callable[[DataFrame, int], None]:
    """A sink that keeps the rows of every batch in a folder of its own."""
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")


def picked(parts: int, columns: str, date: str = "date", event_type: str = "purchase",
           measures: str = POSITION) -> str:
    """SQL of telemetry with the record that the join knows, in so many batches.

    A row takes the last record of the batches before its own; else the first one of its own
    or a later batch.
    """
    return f"""
WITH {EVENTS}, cut AS (SELECT *, event_id * {parts} // (SELECT max(event_id) + 1 FROM events) AS b
  FROM ev),
drv AS (SELECT meeting_key AS m, session_key AS s, driver_number AS d, event_id AS driver_id, b,
    {DRIVER} FROM cut WHERE event_type = 'signup'),
tel AS (SELECT * REPLACE ({date} AS date), {measures} FROM cut WHERE event_type = '{event_type}'),
pick AS (SELECT tel.event_id, max(driver_id) FILTER (drv.b < tel.b) AS last_id,
    min(driver_id) FILTER (drv.b >= tel.b) AS next_id
  FROM tel JOIN drv ON m = meeting_key AND s = session_key AND d = driver_number GROUP BY 1)
SELECT {columns} FROM pick JOIN tel USING (event_id) JOIN drv ON driver_id = coalesce(last_id, next_id)"""


JOINED = """date, meeting_key, session_key, driver_number, position, version, full_name,
  name_acronym, team_name, headshot_url"""


@register("stream_reference_join", picked(3, JOINED))
def stream_reference_join(spark, sf_dir):
    """Three batches; rows wait for the first driver record, and each batch's last one stays."""
    root = scratch_path(spark, "stream-reference-join")
    events = standins.with_number(landed(spark, sf_dir, root, 3))
    drivers = standins.drivers(events).withColumnRenamed("arrival", "version")
    telemetry = standins.position(events).drop("arrival")
    join = ReferenceJoin(telemetry, drivers, f"{root}/tables", full_every=2)
    run.start(
        join.inputs(), "stream-reference-join", f"{root}/checkpoint",
        join.step(batch_rows(f"{root}/rows")), trigger=run.BOUNDED,
    ).awaitTermination()
    schema = T.StructType([*telemetry.schema.fields, *[drivers.schema[c] for c in schemas.DRIVER_COLUMNS]])
    return micros_text(spark.read.schema(schema).parquet(f"{root}/rows").drop("batch"))


@register("stream_reference_updates", picked(4, "event_id, full_name, team_name"))
def stream_reference_updates(spark, sf_dir):
    """Four batches; driver records of three partitions, where the last to arrive counts.

    The known records count as too many to broadcast, and drivers of many rows are spread.
    """
    root = scratch_path(spark, "stream-updates")
    stream = standins.with_number(landed(spark, sf_dir, root, 4))
    telemetry = standins.position(stream).withColumnRenamed("arrival", "event_id")
    drivers = standins.drivers(stream).withColumn("order", F.floor(F.col("arrival") / 3))
    drivers = drivers.withColumn("arrived", F.timestamp_seconds("arrival"))
    join = ReferenceJoin(
        telemetry, drivers, f"{root}/tables", version="order", arrival="arrived",
        salts=4, hot_rows=5, broadcast_rows=0,
    )
    run.start(
        join.inputs(), "stream-updates", f"{root}/checkpoint",
        join.step(batch_rows(f"{root}/rows")), trigger=run.BOUNDED,
    ).awaitTermination()
    schema = "event_id long, full_name string, team_name string"
    return spark.read.schema(schema).parquet(f"{root}/rows").drop("batch")


@register("stream_month_average", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month,
  round(avg(o_totalprice) + 0.00000137, 4) AS average
FROM orders GROUP BY 1""")
def stream_month_average(spark, sf_dir):
    root = scratch_path(spark, "stream-month-average")
    orders = table_stream(spark, sf_dir, "orders")
    monthly = orders.withColumn("month", times.month_start(F.to_date("o_orderdate")))
    updates = stream_averages.average_updates(monthly, ["month"], "o_totalprice")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows")

    with run.state_per_core(spark):
        run.start(
            updates, "stream-month-average", f"{root}/checkpoint", keep, "complete", run.BOUNDED
        ).awaitTermination()
    return rounded(spark.read.schema(updates.schema).parquet(f"{root}/rows"))


@register("stream_running_average", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, count(*) AS n_rows,
  count(DISTINCT o_orderkey) AS n_orders, count(*) AS last_count,
  CAST(count(*) * (count(*) + 1) // 2 AS BIGINT) AS sum_of_counts,
  round(avg(o_totalprice) + 0.00000137, 4) AS average
FROM orders GROUP BY 1""")
def stream_running_average(spark, sf_dir):
    """What does not hang on the order within a batch: every row comes once, with a count of its
    own from 1 on, and the row that counts all has the whole average."""
    orders = table_stream(spark, sf_dir, "orders")
    monthly = orders.withColumn("month", times.month_start(F.to_date("o_orderdate")))
    running = bounded_run(spark, stream_averages.running_average_stream(
        monthly.select("month", "o_orderkey", "o_totalprice"), ["month"], "o_totalprice", counted="counted"
    ), "stream-running-average")
    return rounded(running.groupBy("month").agg(
        F.count("*").alias("n_rows"), F.count_distinct("o_orderkey").alias("n_orders"),
        F.max("counted").alias("last_count"), F.sum("counted").alias("sum_of_counts"),
        F.max_by("average", "counted").alias("average"),
    ))


@register("stream_running_average_batches", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, o_orderkey,
  round(avg(o_totalprice) OVER (PARTITION BY date_trunc('month', o_orderdate)
    ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) + 0.00000137, 4) AS average
FROM orders""")
def stream_running_average_batches(spark, sf_dir):
    """The same by batches, where the order key counts within a batch as well."""
    root = scratch_path(spark, "stream-running-average-batches")
    orders = table_stream(spark, sf_dir, "orders")
    monthly = orders.withColumn("month", times.month_start(F.to_date("o_orderdate")))
    monthly = monthly.select("month", "o_orderkey", "o_totalprice")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows/batch={batch_id}")

    step = stream_averages.running_average_batches(
        ["month"], "o_totalprice", "o_orderkey", f"{root}/sums", keep
    )
    run.start(
        monthly, "stream-running-average-batches", f"{root}/checkpoint", step, trigger=run.BOUNDED
    ).awaitTermination()
    schema = "month string, o_orderkey long, average double"
    return rounded(spark.read.schema(schema).parquet(f"{root}/rows").drop("batch"))


@register("stream_inactivity_average", """
WITH run AS (
  SELECT user_id, ts, lead(ts) OVER w AS following,
    avg(value) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS average
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
  round(average + 0.00000137, 4) AS average
FROM run WHERE (following IS NULL OR following - ts > INTERVAL 6 HOUR)
  AND ts + INTERVAL 6 HOUR < (SELECT max(ts) FROM events)""")
def stream_inactivity_average(spark, sf_dir):
    """Five batches: every silence of every user whose end the newest event has passed."""
    root = scratch_path(spark, "stream-inactivity")
    events = landed(spark, sf_dir, root, 5)
    step = stream_averages.inactivity_average_batches(
        ["user_id"], "value", "ts", f"{root}/state", batch_rows(f"{root}/rows"), SIX_HOURS
    )
    run.start(
        events.select("user_id", "ts", "value"), "stream-inactivity", f"{root}/checkpoint", step,
        trigger=run.BOUNDED,
    ).awaitTermination()
    schema = "user_id long, ts timestamp, average double"
    return rounded(micros_text(spark.read.schema(schema).parquet(f"{root}/rows").drop("batch"), "ts"))


@register("stream_lookup_enrich_json", LOOKUP_JSON)
def stream_lookup_enrich_json(spark, sf_dir):
    root = scratch_path(spark, "stream-lookup")
    messages = standins.order_messages(table_stream(spark, sf_dir, "orders"))
    messages = messages.withColumn("original", F.col("value"))

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows/batch={batch_id}")

    jobs.order_enrichment(
        messages, lambda: standins.customers(spark, sf_dir), append, f"{root}/checkpoint",
        name="stream-lookup", trigger=run.BOUNDED,
    ).awaitTermination()
    rows = spark.read.schema(messages.schema).parquet(f"{root}/rows")
    return read_back(rows.select("message_key", "value", "original"))


@register("race_position_job", picked(
    3, JOINED, "strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%f')"
))
def race_position_job(spark, sf_dir):
    """Kafka-shaped JSON rows of two topics, in three batches, through the job into the serving table."""
    root = scratch_path(spark, "race-position")
    events = standins.with_number(landed(spark, sf_dir, root, 3))
    jobs.start_telemetry(
        standins.kafka_rows(standins.position(events)), standins.kafka_rows(standins.drivers(events)),
        "position", serving.batch_writer("position", path=f"{root}/position"), f"{root}/checkpoint",
        run.BOUNDED,
    ).awaitTermination()
    table = versions.consistent_read(serving.read_path(spark, "position", f"{root}/position"))
    return micros_text(table.withColumn("driver_number", F.col("driver_number").cast("long")))


def sunk(feed: str, event_type: str, measures: str) -> str:
    """SQL of a telemetry table of the race job, in the columns of ``four_sink_job``."""
    listed = ", ".join(schemas.MEASURES[feed])
    columns = f"""'{feed}' AS feed, meeting_key, session_key, driver_number, date, version,
  concat_ws(',', {listed}) AS measures, full_name"""
    millis = "strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%f')"
    return f"SELECT * FROM ({picked(2, columns, millis, event_type, measures)})"


@register("four_sink_job", f"""
{sunk("position", "purchase", POSITION)}
UNION ALL {sunk("car_data", "click", CAR)}
UNION ALL {sunk("location", "view", LOCATION)}
UNION ALL SELECT * FROM (WITH {EVENTS}
  SELECT 'drivers' AS feed, meeting_key, session_key, driver_number, NULL AS date, NULL AS version,
    'D' || user_id AS measures, 'driver ' || user_id || ' v' || event_id AS full_name
  FROM ev WHERE event_type = 'signup')""")
def four_sink_job(spark, sf_dir):
    """The four topics of the race job, in two batches each, into their four tables."""
    root = scratch_path(spark, "race")
    events = standins.with_number(landed(spark, sf_dir, root, 2))
    topics = {feed: standins.kafka_rows(of(events)) for feed, of in standins.TELEMETRY.items()}
    topics["drivers"] = standins.kafka_rows(standins.drivers(events))
    started = jobs.race_telemetry(
        topics, jobs.folder_writer(f"{root}/tables"), f"{root}/checkpoint", run.BOUNDED
    )
    for query in started:
        query.awaitTermination()
    tables = []
    for feed in schemas.SERVING:
        table = serving.read_path(spark, feed, f"{root}/tables/{feed}").distinct()
        measures = schemas.MEASURES.get(feed, ("name_acronym",))
        if feed == "drivers":
            table = table.withColumns({
                "date": F.lit(None).cast("timestamp"), "version": F.lit(None).cast("long"),
            })
        tables.append(micros_text(table).select(
            F.lit(feed).alias("feed"), "meeting_key", "session_key",
            F.col("driver_number").cast("long").alias("driver_number"), "date", "version",
            F.concat_ws(",", *[F.col(name).cast("string") for name in measures]).alias("measures"),
            "full_name",
        ))
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return whole
