"""Files, serving tables, Kafka and JDBC options."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from frames import plan_text, rows
from rillflow import schemas
from rillflow.plans import jobs
from rillflow.sinks import console, files, kafka as kafka_sink, serving
from rillflow.sources import files as file_source, kafka, lookup

LINES = [
    "Date,Open,High,Low,Close,Volume", "2023-12-29,1,1,1,10,5", "2024-01-02,1,1,1,20,5",
    "2024-01-03,1,1,1,40,1.5,5",
]


def text_folder(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    return path


def test_stock_job_from_file_to_year_folders(spark, folder):
    lines = file_source.text_lines(spark, text_folder(spark, folder(), LINES))
    out = folder()
    jobs.stock_averages(lines, out)
    read = spark.read.schema("date string, average double, year int").parquet(out)
    assert rows(read) == [("2023-12-01", 10.0, 2023), ("2024-01-01", 30.0, 2024)]
    one = read.filter("year = 2024")
    assert "PartitionFilters: [isnotnull(year" in plan_text(one) and one.count() == 1


def test_running_job(spark):
    lines = spark.createDataFrame([(n, t) for n, t in enumerate(LINES)], "n int, value string")
    assert rows(jobs.running_month_averages(lines, "n")) == [
        ("2023-12-01", 1, 10.0), ("2024-01-01", 2, 20.0), ("2024-01-01", 3, 30.0),
    ]


def test_landed_json(spark, folder):
    record = '{"date": "2026-05-03T20:00:00+00:00", "x": -4, "driver_number": 1, "odd": 1}'
    path = text_folder(spark, folder(), [record])
    row = file_source.landed_records(spark, path, "location").first()
    assert (row.x, row.y, row.date) == (-4, 0, datetime(2026, 5, 3, 20))
    assert file_source.landed_records(spark, path, "location", stream=True).isStreaming
    drivers = text_folder(spark, folder(), ['{"driver_number": 1, "full_name": "A"}'])
    assert file_source.landed_records(spark, drivers, "drivers").first().full_name == "A"


def test_tables_are_created_once_and_dropped(spark, folder):
    root = folder()
    serving.create_tables(spark, location=root)
    serving.create_tables(spark, location=root)
    for table in schemas.SERVING:
        serving.check_table(spark, table)
    row = (1, 2, 3, "A", "Full", "Team", "url")
    drivers = spark.createDataFrame([row], "meeting_key long, session_key long, "
        "driver_number int, name_acronym string, full_name string, team_name string, "
        "headshot_url string")
    for _ in range(2):
        serving.append(drivers, "drivers")
    assert spark.table("drivers").count() == 2
    assert rows(spark.table("drivers").select(*drivers.columns).distinct()) == [row]
    serving.drop_tables(spark)
    serving.drop_tables(spark)
    assert not any(spark.catalog.tableExists(table) for table in schemas.SERVING)


def test_a_table_of_another_shape_is_reported(spark, folder):
    spark.sql(f"CREATE TABLE location (x int) USING parquet LOCATION '{folder()}'")
    try:
        serving.create_tables(spark, location=folder())
        with pytest.raises(ValueError, match="does not match its schema"):
            serving.check_table(spark, "location")
    finally:
        serving.drop_tables(spark)


def test_rows_must_fit_the_table(spark):
    columns = schemas.SERVING["position"].fieldNames()
    df = spark.range(1).select(*[F.lit(1).alias(name) for name in columns])
    dated = df.withColumn("date", F.lit("2026-05-03 20:00:00.123456").cast("timestamp"))
    kinds = [field.dataType for field in serving.conform(dated, "position").schema]
    assert kinds == [field.dataType for field in schemas.SERVING["position"]]
    assert serving.conform(dated, "position").first().date.microsecond == 123000
    with pytest.raises(ValueError, match="columns differ"):
        serving.conform(dated.drop("position"), "position")
    with pytest.raises(Exception, match="OVERFLOW"):
        serving.conform(dated.withColumn("position", F.lit(70_000)), "position").collect()


def test_a_big_session_is_written_by_many_tasks(spark):
    df = spark.range(10_000).select(
        F.lit(1).alias("meeting_key"), F.lit(1).alias("session_key"),
        (F.col("id") % 20).alias("driver_number"), F.timestamp_seconds("id").alias("date"),
    )
    spread = serving.in_key_ranges(df, "location").groupBy(F.spark_partition_id()).count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert max(r["count"] for r in spread.collect()) < 6_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_kafka_source_options():
    options = kafka.source_options("b:9092", "orders", group="g", max_offsets=500)
    assert options == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "orders",
        "startingOffsets": "earliest", "kafka.isolation.level": "read_committed",
        "kafka.group.id": "g", "maxOffsetsPerTrigger": "500",
    }
    assert "kafka.isolation.level" not in kafka.source_options("b", "t", committed_only=False)


def test_start_positions():
    assert kafka.start_position("t") == "earliest"
    assert kafka.start_position("t", "end") == "latest"
    assert json.loads(kafka.start_position("t", 42, [0, 2], {1: 7})) == {
        "t": {"0": 42, "1": 7, "2": 42}
    }
    assert json.loads(kafka.start_position("t", "beginning", [0])) == {"t": {"0": -2}}
    assert json.loads(kafka.start_position("t", "end", [0])) == {"t": {"0": -1}}
    with pytest.raises(ValueError):
        kafka.start_position("t", 42)
    with pytest.raises(ValueError):
        kafka.start_position("t", "middle")
    assert kafka.parse_partitions("0, 2,") == [0, 2]
    assert kafka.parse_partitions(None) is None


KAFKA_ROW = (
    "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
)


def kafka_rows(spark, topic, records):
    return spark.createDataFrame(
        [(None, bytearray(json.dumps(value).encode()), topic, part, offset, datetime(2026, 1, 1))
         for part, offset, value in records], KAFKA_ROW,
    )


def test_version_comes_from_the_kafka_row(spark):
    value = {"date": "2026-05-03T20:00:00Z", "x": 1, "version": 77, "driver_number": 4}
    row = kafka.versioned_records(kafka_rows(spark, "l", [(2, 5, value)]), "location").first()
    assert (row.version, row.x, row.date) == (2_000_000_000_005, 1, datetime(2026, 5, 3, 20))
    rows_ = kafka_rows(spark, "d", [(0, 1, {"full_name": "A"})])
    assert kafka.typed_records(rows_, "drivers").first().full_name == "A"
    assert [r.value for r in kafka.strings(rows_).collect()] == ['{"full_name": "A"}']


def test_kafka_sink(spark):
    assert kafka_sink.sink_options("b", "t", linger_ms=50, compression="lz4") == {
        "kafka.bootstrap.servers": "b", "topic": "t", "kafka.linger.ms": "50",
        "kafka.compression.type": "lz4",
    }
    df = spark.createDataFrame([(datetime(2026, 5, 3, 20), 1, None)], "date timestamp, a int, b int")
    assert kafka_sink.as_messages(df).columns == ["value"]
    assert json.loads(kafka_sink.as_messages(df).first().value) == {
        "date": "2026-05-03T20:00:00.000000Z", "a": 1, "b": None,
    }


def test_jdbc_lookup_options():
    options = lookup.jdbc_options("jdbc:postgresql://h/db", user="u", password="p", partitions=4)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4"
    assert options["dbtable"] == "customers" and options["user"] == "u"
    assert "user" not in lookup.jdbc_options("jdbc:postgresql://h/db")


def test_parquet_lookup(spark, folder):
    path = folder()
    spark.createDataFrame([(1, "n", 2, "a", datetime(2024, 1, 1))], schemas.CUSTOMER) \
        .write.parquet(path)
    assert lookup.parquet_lookup(spark, path).first().name == "n"


def test_console(spark, capsys):
    console.print_rows(spark.range(3).withColumnRenamed("id", "shown"))
    assert "shown" in capsys.readouterr().out


def test_year_column(spark):
    df = spark.createDataFrame([("2024-02-01", 1.0)], "date string, average double")
    assert files.with_year(df).first().year == 2024
