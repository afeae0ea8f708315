import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm import fixity

SCHEMA = T.StructType([
    T.StructField("volume", T.StringType()), T.StructField("ordinal", T.LongType()),
    T.StructField("record", T.StringType()), T.StructField("hash", T.StringType()),
])


def replica(volumes=("a", "b", None), n=300):
    return [(v, i, f"record {i} of {v} " + "é" * (i % 7), "x") for v in volumes for i in range(n)]


@pytest.mark.parametrize("fanout", [4, 64])
def test_differences(spark, fanout):
    one = replica()
    other = [
        (v, i, t + "!" if (v, i) == ("a", 17) else t, "x") for v, i, t, _ in one
        if (v, i) not in {("b", 299), (None, 5)}
    ] + [("a", 300, "extra", "x")]
    trees = [fixity.tree(spark.createDataFrame(x, SCHEMA), fanout=fanout) for x in (one, other)]
    found = {(r["volume_"], r["at"]): r for r in fixity.audit(*trees, fanout=fanout).collect()}
    size = {(v, i): len(t.encode()) for v, i, t, _ in one}
    offset = lambda v, at: sum(size[v, i] for i in range(at))
    assert {k: r["problem"] for k, r in found.items()} == {
        ("a", 17): "changed", ("b", 299): "missing", (None, 5): "missing", ("a", 300): "extra",
    }
    assert found["a", 17]["offset"] == offset("a", 17)
    assert found["a", 17]["other_bytes"] == found["a", 17]["bytes"] + 1
    assert found["b", 299]["offset"] == offset("b", 299)
    assert found["a", 300]["offset"] == offset("a", 300) + 1


def test_equal_and_odd(spark):
    rows = replica(n=20) + [("a", 3, "twice", "x"), ("a", 3, "twice", "x"), ("b", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    trees = [fixity.tree(x) for x in (df, df.orderBy(F.rand(1)))]
    assert fixity.audit(*trees).count() == 0
    changed = spark.createDataFrame(rows[:-1], SCHEMA)
    found = fixity.audit(trees[0], fixity.tree(changed)).collect()
    assert [(r["volume_"], r["at"], r["problem"]) for r in found] == [("b", -1, "missing")]
    none = spark.createDataFrame([], SCHEMA)
    assert fixity.audit(fixity.tree(none), fixity.tree(none)).count() == 0
    # A replica without anything misses every record.
    assert fixity.audit(fixity.tree(df), fixity.tree(none)).filter("problem = 'missing'").count() == 61


def test_record(spark):
    df = spark.createDataFrame([("http://x/é", "<p>ü</p>"), (None, None)], "url string, html string")
    found = [r[0] for r in df.select(fixity.warc_record(F.col("url"), F.col("html"))).collect()]
    assert found[0] == (
        "WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/é\r\nContent-Length: 9\r\n\r\n"
        "<p>ü</p>\r\n\r\n"
    )
    assert found[1].endswith("Content-Length: 0\r\n\r\n\r\n\r\n")


def test_a_middle_record_of_one_place_counts(spark):
    """Of many records at one place, here without ordinals, any single change shows."""
    rows = [("a", None, f"record {i}", "x") for i in range(9)]
    whole = fixity.tree(spark.createDataFrame(rows, SCHEMA))
    for i in range(9):
        damaged = [(*r[:2], r[2] + "!" if n == i else r[2], "x") for n, r in enumerate(rows)]
        found = fixity.audit(whole, fixity.tree(spark.createDataFrame(damaged, SCHEMA))).collect()
        assert [(r["volume_"], r["at"], r["problem"]) for r in found] == [("a", -1, "changed")]
    # The same number of records, but one twice and another not at all.
    swapped = fixity.tree(spark.createDataFrame([*rows[:-1], rows[0]], SCHEMA))
    assert fixity.audit(whole, swapped).count() == 1
