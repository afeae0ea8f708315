"""Column expressions on edge rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rillflow import schemas
from rillflow.functions import keys, lines, payloads, times
from rillflow.operators import merge, prices, reference


def values(spark, texts, expression):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    return [row[0] for row in df.orderBy("n").select(expression(F.col("t"))).collect()]


def test_headers_anywhere(spark):
    assert values(spark, ["Date,Open", "DATE", "2024-01-02,1"], lines.is_header) == [
        True, True, False,
    ]


PRICE_LINES = [
    "2024-01-02,1,2,0.5,1.5,900",
    "Date,Open,High,Low,Close,Volume",
    "2024-01-03,1,2,0.5,1.5,1.4,901",
    "2024-01-04,1,2,0.5,1.5,3000000000,902",
]


def test_price_lines(spark):
    df = spark.createDataFrame([(t,) for t in PRICE_LINES], "value string")
    parsed = prices.parse_prices(df).orderBy("date").collect()
    assert [row.volume for row in parsed] == [900, 901, 902]
    assert tuple(parsed[0])[:5] == ("2024-01-02", 1.0, 2.0, 0.5, 1.5)


@pytest.mark.parametrize("line", [
    "2024-01-02,1,2,0.5,1.5,3000000000",
    "2024-01-02,x,2,0.5,1.5,10",
    "2024-13-02,1,2,0.5,1.5,10",
    "2024-01-02,1,2",
])
def test_bad_price_lines(spark, line):
    df = spark.createDataFrame([(line,), (PRICE_LINES[0],)], "value string")
    with pytest.raises(Exception, match="not a price line"):
        prices.parse_prices(df).select("date").collect()
    good, bad = prices.divert_prices(df)
    assert good.count() == 1
    assert [row.value for row in bad.collect()] == [line]


def test_month_and_year(spark):
    month = lambda t: times.month_start(times.to_day(t))
    assert values(spark, ["2024-02-29", "2024-1-5", "x"], month) == ["2024-02-01", None, None]
    year = lambda t: times.year_text(times.to_day(t))
    assert values(spark, ["2024-02-29"], year) == ["2024"]


def test_instants(spark):
    texts = [
        "2026-05-03T20:00:00Z", "2026-05-03T20:00:00.123+00:00", "2026-05-03T22:00:00+02:00",
        "2026-05-03T20:00:00", "2026-05-03T20:00:00.123456", "", "   ", None,
    ]
    show = lambda t: F.date_format(times.parse_instant(t), "HH:mm:ss.SSSSSS")
    assert values(spark, texts, show) == [
        "20:00:00.000000", "20:00:00.123000", "20:00:00.000000", "20:00:00.000000",
        "20:00:00.123456", None, None, None,
    ]


@pytest.mark.parametrize("text", ["2026", "2026-05-03", "soon", "2026-13-03T20:00:00Z"])
def test_instants_rejected(spark, text):
    with pytest.raises(Exception, match="not an ISO date-time"):
        values(spark, [text], times.parse_instant)
    assert values(spark, [text], lambda t: times.parse_instant(t, strict=False)) == [None]


def test_instants_do_not_follow_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        micros = lambda t: F.unix_micros(times.parse_instant(t))
        assert values(spark, ["1970-01-01T00:00:01"], micros) == [1_000_000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_time_texts(spark):
    stamp = lambda t: t.cast("timestamp")
    texts = ["2026-05-03 20:00:00", "2026-05-03 20:00:00.1239", "2026-05-03 20:00:00.12045", None]
    assert values(spark, texts, lambda t: times.format_millis(stamp(t))) == [
        "2026-05-03 20:00:00.000", "2026-05-03 20:00:00.123", "2026-05-03 20:00:00.120", None,
    ]
    assert values(spark, texts, lambda t: times.trimmed_fraction(stamp(t))) == [
        "2026-05-03 20:00:00.0", "2026-05-03 20:00:00.1239", "2026-05-03 20:00:00.12045", None,
    ]
    assert values(spark, texts[:1], lambda t: times.epoch_millis(stamp(t))) == [1777838400000]


def test_keys(spark):
    df = spark.createDataFrame([(2, 5)], "partition int, offset long")
    version = keys.record_version(F.col("partition"), F.col("offset"))
    assert df.select(version).first()[0] == 2_000_000_000_005
    assert df.select(keys.join_key(F.lit(1), F.lit(2), F.lit(3))).first()[0] == "1|2|3"


def test_blank_to_null(spark):
    assert values(spark, ["", "  ", "a"], times.blank_to_null) == [None, None, "a"]


def test_int_field(spark):
    texts = [
        '{"customer_id": 12}', '{"customer_id": "12"}', '{"customer_id": 3.7}',
        '{"customer_id": null}', '{"customer_id": "abc"}', '{"customer_id": true}',
        '{"customer_id": {}}', '{"customer_id": "3.7"}',
    ]
    read = lambda t: payloads.int_field(F.try_parse_json(t), "customer_id")
    assert values(spark, texts, read) == [12, 12, 3, 0, 0, 1, 0, 3]


def test_has_field(spark):
    texts = ['{"customer_id": null}', '{"other": 1}', "{bad", '[{"customer_id": 1}]', "5"]
    read = lambda t: payloads.has_field(F.try_parse_json(t), "customer_id")
    assert values(spark, texts, read) == [True, False, False, False, False]


def test_json_rows_keep_order_and_nulls(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 5, 3, 20, 0, 0, 123999), 7, 9, 8, -1, -2, None, 5)],
        "date timestamp, driver_number int, session_key long, meeting_key long, "
        "x long, y long, z long, version long",
    )
    text = df.select(payloads.json_row("location")).first()[0]
    fields = json.loads(text)
    assert list(fields) == list(schemas.JSON_ROW_FIELDS["location"])
    assert fields["date"].endswith(".123") and fields["z"] is None and fields["x"] == -1


@pytest.mark.parametrize("record_type", schemas.JSON_ROW_FIELDS)
def test_json_row_types(spark, record_type):
    names = schemas.JSON_ROW_FIELDS[record_type]
    df = spark.range(1).select(*[
        (F.lit("2026-05-03 20:00:00").cast("timestamp") if name == "date" else F.lit(1)).alias(name)
        for name in names
    ])
    assert list(json.loads(df.select(payloads.json_row(record_type)).first()[0])) == list(names)


def test_decode(spark):
    texts = ['{"driver_number": 4, "other": 1, "full_name": "A"}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    row = payloads.decode(df, schemas.DRIVER_FEED).first()
    assert (row.driver_number, row.full_name, row.session_key, row.team_name) == (4, "A", 0, None)
    row = payloads.decode(df, schemas.DRIVER_FEED, zero_missing=False).first()
    assert row.session_key is None


def test_decode_malformed(spark):
    torn = spark.createDataFrame([('{"x": 1}',), ("{bad",)], "value string")
    with pytest.raises(Exception, match="MALFORMED"):
        payloads.decode(torn, schemas.LOCATION_FEED).collect()
    worded = spark.createDataFrame([('{"x": 1}',), ('{"x": "word"}',)], "value string")
    with pytest.raises(Exception, match="not a record"):
        payloads.decode(worded, schemas.LOCATION_FEED).collect()
    df = torn.union(worded.filter("value LIKE '%word%'"))
    good, bad = payloads.decode_or_divert(df, schemas.LOCATION_FEED)
    assert [row.x for row in good.collect()] == [1]
    assert {row.value for row in bad.collect()} == {"{bad", '{"x": "word"}'}


def test_playback_speed_must_be_positive():
    for speed in (0, -1):
        with pytest.raises(ValueError):
            times.playback_offset(F.lit(1), F.lit(1), speed)


def test_merge_and_schedule(spark):
    at = lambda second: datetime(2026, 5, 3, 20, 0, second)
    cars = spark.createDataFrame([(at(30), 1, 5)], "date timestamp, sequence long, speed int")
    spots = spark.createDataFrame(
        [(at(0), 1, 7), (at(30), 2, 8)], "date timestamp, sequence long, x int"
    )
    merged = merge.tag_and_union({"location": spots, "car_data": cars})
    ordered = merge.in_event_time(merge.with_schedule(merged, 60)).collect()
    assert [(row.topic, row.offset_seconds) for row in ordered] == [
        ("location", 0.0), ("car_data", 0.5), ("location", 0.5),
    ]
    assert ordered[0].speed is None and ordered[1].x is None


def test_event_date_is_required(spark):
    df = spark.createDataFrame([(None, 1), (datetime(2026, 1, 1), 2)], "date timestamp, n int")
    assert [row.n for row in reference.with_event_date(df).collect()] == [2]
    with pytest.raises(Exception, match="missing its event date"):
        reference.with_event_date(df, strict=True).select("n").collect()
