"""Declared schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "short": T.ShortType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "timestamp": T.TimestampType(),
}


def columns(listing: str) -> T.StructType:
    """``"name type, ..."`` to a schema; unlike ``fromDDL`` it needs no session."""
    pairs = (entry.split() for entry in listing.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PRICE = columns(
    "date string, open double, high double, low double, close double, volume int"
)

ORDER = columns(
    "customer_id int, order_id int, product_id int, created_at string, "
    "status string, payment_method string, amount double"
)

CUSTOMER = columns(
    "id int, name string, age int, address string, created_at timestamp"
)

CUSTOMER_FIELDS = (
    "customer_name",
    "customer_age",
    "customer_address",
    "customer_created_at",
)

# Input feeds. Dates arrive as text and are parsed by functions.times.parse_instant.
DRIVER_FEED = columns(
    "meeting_key int, session_key int, driver_number int, full_name string, "
    "name_acronym string, team_name string, headshot_url string"
)
CAR_FEED = columns(
    "date string, driver_number int, session_key long, meeting_key long, speed int, "
    "n_gear short, rpm int, throttle int, brake int, version long"
)
LOCATION_FEED = columns(
    "date string, driver_number int, session_key long, meeting_key long, "
    "x long, y long, z long, version long"
)
POSITION_FEED = columns(
    "date string, session_key long, meeting_key long, driver_number int, "
    "position short, version long"
)

FEEDS = {
    "drivers": DRIVER_FEED,
    "car_data": CAR_FEED,
    "location": LOCATION_FEED,
    "position": POSITION_FEED,
}

# What each telemetry feed carries besides its identity columns.
MEASURES = {
    "car_data": ("speed", "n_gear", "rpm", "throttle", "brake"),
    "location": ("x", "y", "z"),
    "position": ("position",),
}

DRIVER_KEYS = ("meeting_key", "session_key", "driver_number")
DRIVER_COLUMNS = ("full_name", "name_acronym", "team_name", "headshot_url")
SERVING_KEYS = (*DRIVER_KEYS, "date")
SERVING_PARTITIONS = ("meeting_key", "session_key")

# Serving tables. Unsigned source types take a wider signed type; driver numbers are int
# as in the feeds, so that keys compare without casts.
SERVING = {
    "drivers": columns(
        "meeting_key long, session_key long, driver_number int, name_acronym string, "
        "full_name string, team_name string, headshot_url string"
    ),
    "car_data": columns(
        "date timestamp, driver_number int, session_key long, meeting_key long, "
        "speed int, n_gear short, rpm int, throttle int, brake int, full_name string, "
        "name_acronym string, team_name string, headshot_url string, version long"
    ),
    "location": columns(
        "date timestamp, driver_number int, session_key long, meeting_key long, "
        "x int, y int, z int, full_name string, name_acronym string, team_name string, "
        "headshot_url string, version long"
    ),
    "position": columns(
        "date timestamp, session_key long, meeting_key long, driver_number int, "
        "position short, full_name string, name_acronym string, team_name string, "
        "headshot_url string, version long"
    ),
}

# Field order of the JSON rows, by record type (fixed output format).
JSON_ROW_FIELDS = {
    "driver": (
        "meeting_key", "session_key", "driver_number",
        "name_acronym", "full_name", "team_name", "headshot_url",
    ),
    "car_data": (
        "date", "driver_number", "session_key", "meeting_key",
        "speed", "n_gear", "rpm", "throttle", "brake", "version",
    ),
    "location": (
        "date", "driver_number", "session_key", "meeting_key", "x", "y", "z", "version",
    ),
    "position": (
        "date", "session_key", "meeting_key", "driver_number", "position", "version",
    ),
    "enriched_car_data": (
        "date", "driver_number", "session_key", "meeting_key",
        "speed", "n_gear", "rpm", "throttle", "brake", "version",
        "full_name", "name_acronym", "team_name", "headshot_url",
    ),
    "enriched_location": (
        "date", "driver_number", "session_key", "meeting_key", "x", "y", "z",
        "full_name", "name_acronym", "team_name", "headshot_url", "version",
    ),
    "enriched_position": (
        "date", "session_key", "meeting_key", "driver_number", "position",
        "full_name", "name_acronym", "team_name", "headshot_url", "version",
    ),
}
