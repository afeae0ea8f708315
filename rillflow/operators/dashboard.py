"""Reads behind a live dashboard, over the serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow import schemas
from rillflow.operators.versions import consistent_read, latest_by


def _latest(table: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return latest_by(
        table,
        schemas.DRIVER_KEYS,
        ["date", "version"],
        [*columns, *schemas.DRIVER_COLUMNS],
    )


def current_positions(position: DataFrame) -> DataFrame:
    """Latest position of every driver, in race order."""
    return _latest(position, schemas.MEASURES["position"]).orderBy(
        "position", *schemas.DRIVER_KEYS
    )


def top_cards(position: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` drivers; each task keeps only its own first ``n``."""
    return current_positions(position).limit(n)


def latest_car_data(car_data: DataFrame) -> DataFrame:
    """Latest speed, gear, RPM, throttle and brake of every driver."""
    return _latest(car_data, schemas.MEASURES["car_data"])


def latest_location(location: DataFrame) -> DataFrame:
    """Latest track location of every driver."""
    return _latest(location, schemas.MEASURES["location"])


def _chosen(table: DataFrame, driver: int | None) -> DataFrame:
    return table if driver is None else table.filter(F.col("driver_number") == F.lit(driver))


def track_trace(location: DataFrame, driver: int | None = None) -> DataFrame:
    """Points of the track as driven, newest versions only, in time order."""
    trace = consistent_read(_chosen(location, driver))
    return trace.select(*schemas.DRIVER_KEYS, "date", "x", "y").orderBy(*schemas.SERVING_KEYS)


def telemetry_series(
    car_data: DataFrame,
    start: Column | None = None,
    end: Column | None = None,
    driver: int | None = None,
) -> DataFrame:
    """Telemetry over time, ``start`` included and ``end`` not, newest versions only."""
    rows = _chosen(car_data, driver)
    if start is not None:
        rows = rows.filter(F.col("date") >= start)
    if end is not None:
        rows = rows.filter(F.col("date") < end)
    return (
        consistent_read(rows)
        .select(*schemas.DRIVER_KEYS, "date", *schemas.MEASURES["car_data"])
        .orderBy(*schemas.SERVING_KEYS)
    )
