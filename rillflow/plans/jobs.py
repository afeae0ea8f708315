"""The three jobs, put together from the operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rillflow import schemas
from rillflow.operators import averages, lookup, prices
from rillflow.sinks import files, serving
from rillflow.sources import kafka
from rillflow.streaming import run
from rillflow.streaming.reference import reference_join_stream
from rillflow.streaming.reference_tables import ReferenceJoin

TELEMETRY = ("car_data", "location", "position")


# Stock averages ---------------------------------------------------------------------

def month_averages(lines: DataFrame) -> DataFrame:
    """Price lines to one average close per month: (date, average)."""
    monthly = prices.with_month(prices.parse_prices(lines))
    return prices.month_record(averages.total_average(monthly, ["month"], "close"))


def running_month_averages(lines: DataFrame, order: str) -> DataFrame:
    """Price lines to the average close so far in the month, one row per line.

    ``order`` names a column of ``lines`` that gives the order of arrival.
    """
    monthly = prices.with_month(prices.parse_prices(lines, keep=[order]))
    return averages.running_average(monthly, ["month"], "close", order).select(
        "month", order, "average"
    )


def stock_averages(lines: DataFrame, output: str) -> None:
    """Monthly averages as Parquet, one folder per year."""
    files.write_by_year(month_averages(lines), output)


# Order enrichment -------------------------------------------------------------------

def order_enrichment(
    messages: DataFrame,
    customers: Callable[[], DataFrame],
    sink: Callable[[DataFrame, int], None],
    checkpoint_root: str,
    name: str = "order_enrichment",
    trigger: dict | None = None,
    salts: int = 16,
    ordered: bool = False,
    **sizing,
) -> StreamingQuery:
    """Stream of JSON orders to a sink of JSON orders with customer fields.

    ``customers`` is called for every micro-batch, so the lookup is as fresh as the
    batch and its size is checked each time. ``salts`` counts only where the lookup is
    too large to broadcast. With ``ordered`` the messages carry ``partition`` and ``offset``,
    and the sink gets those of each partition in one task and in the order of their offsets.
    """

    def enrich(batch: DataFrame, batch_id: int) -> None:
        found = lookup.enrich_json(batch, customers(), salts=salts, **sizing)
        sink(lookup.in_source_order(found, one_task=True) if ordered else found, batch_id)

    return run.start(messages, name, checkpoint_root, enrich, trigger=trigger)


# Race telemetry ---------------------------------------------------------------------

def enriched_telemetry(
    telemetry_rows: DataFrame, driver_rows: DataFrame, feed: str, salts: int = 8
) -> DataFrame:
    """Kafka rows of a telemetry topic and the driver topic to serving-table rows."""
    joined = reference_join_stream(
        kafka.versioned_records(telemetry_rows, feed),
        kafka.ordered_drivers(driver_rows),
        version="order",
        salts=salts,
        arrival="kafka_time",
    )
    return joined.select(*schemas.SERVING[feed].fieldNames())


def telemetry_join(
    telemetry_rows: DataFrame, driver_rows: DataFrame, feed: str, state_path: str, salts: int = 8
) -> ReferenceJoin:
    """The same join on tables below ``state_path``, by built-in joins per micro-batch."""
    return ReferenceJoin(
        kafka.versioned_records(telemetry_rows, feed),
        kafka.ordered_drivers(driver_rows),
        state_path,
        version="order",
        arrival="kafka_time",
        salts=salts,
    )


def start_telemetry(
    telemetry_rows: DataFrame,
    driver_rows: DataFrame,
    feed: str,
    writer: Callable[[DataFrame, int], None],
    checkpoint_root: str,
    trigger: dict | None = None,
    salts: int = 8,
    name: str | None = None,
) -> StreamingQuery:
    """Start the query of one telemetry topic into its serving table.

    Its tables lie beside its checkpoint, as they belong to it.
    """
    name = name or feed
    join = telemetry_join(telemetry_rows, driver_rows, feed, f"{checkpoint_root}/{name}-tables", salts)
    columns = schemas.SERVING[feed].fieldNames()

    def write(rows: DataFrame, batch_id: int) -> None:
        writer(rows.select(*columns), batch_id)

    return run.start(join.inputs(), name, checkpoint_root, join.step(write), trigger=trigger)


def race_telemetry(
    topics: Mapping[str, DataFrame],
    writer: Callable[[str], Callable[[DataFrame, int], None]],
    checkpoint_root: str,
    trigger: dict | None = None,
    salts: int = 8,
) -> list[StreamingQuery]:
    """Start the four queries of the race job.

    ``topics`` maps each feed to its stream of Kafka rows and ``writer`` gives the
    ``foreachBatch`` function of a serving table, such as :func:`serving.batch_writer`.
    """
    drivers = kafka.typed_records(topics["drivers"], "drivers")
    queries = [run.start(drivers, "drivers", checkpoint_root, writer("drivers"), trigger=trigger)]
    for feed in TELEMETRY:
        queries.append(start_telemetry(
            topics[feed], topics["drivers"], feed, writer(feed), checkpoint_root, trigger, salts
        ))
    return queries


def folder_writer(root: str) -> Callable[[str], Callable[[DataFrame, int], None]]:
    """Writers for serving tables kept as Parquet folders below ``root``."""
    return lambda table: serving.batch_writer(table, path=f"{root}/{table}")
