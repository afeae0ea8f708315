"""Fixity audit of replicated WARC records by hash trees.

Leaves are the digests of records in their order inside a volume; every node above covers an
ordered range of them and digests its children with their byte counts. Replicas with equal
roots hold the same bytes. Where roots differ, only differing branches are followed, and
the byte offsets of what differs come from the byte counts of earlier siblings on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillflow.llm.common import held

FANOUT = 64


def warc_record(url: Column, payload: Column) -> Column:
    """A WARC response record: header lines, an empty line, the payload, two line ends."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def tree(records: DataFrame, volume: str = "volume", ordinal: str = "ordinal",
         record: str = "record", fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of the trees of all volumes, from the leaves up: (volume_, at, hash, bytes).

    Nothing but digests and counts leaves the tasks that read the records. A node gathers at
    most ``fanout`` children. Several records at one place form one leaf of their number and
    the sums of the words of all their digests, in no order; null volumes are one volume, null
    ordinals come first.
    """
    bytes_ = F.octet_length(record).cast("long")
    # Four words of 60 bits; their sums tell which digests there are, however many.
    words = [
        F.sum(F.conv(F.substring(F.sha2("hash", 256), 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)"))
        .alias(f"word{i}") for i in range(4)
    ]
    leaves = records.select(
        F.col(volume).alias("volume_"), F.coalesce(F.col(ordinal).cast("long") + 1, F.lit(0)).alias("at"),
        F.coalesce(F.sha2(F.col(record).cast("binary"), 256), F.lit("null")).alias("hash"),
        F.coalesce(bytes_, F.lit(0)).alias("bytes"),
    ).groupBy("volume_", "at").agg(
        F.count("*").alias("n"), F.min("hash").alias("low"), F.sum("bytes").alias("bytes"), *words
    ).select(
        "volume_", "at",
        F.when(F.col("n") == 1, F.col("low")).otherwise(
            F.sha2(F.concat_ws(",", *[F.col(c).cast("string") for c in ("n", *(f"word{i}" for i in range(4)))]), 256)
        ).alias("hash"),
        "bytes",
    )
    levels = [held(leaves, "tree")]
    top = levels[0].agg(F.max("at")).first()[0] or 0
    while top > 0:
        top //= fanout
        levels.append(held(_above(levels[-1], fanout), "tree"))
    return levels


def _above(level: DataFrame, fanout: int) -> DataFrame:
    child = F.struct("at", "bytes", "hash")
    said = F.transform(F.sort_array(F.collect_list(child)), lambda x: F.concat_ws(
        ":", x["at"].cast("string"), x["bytes"].cast("string"), x["hash"]
    ))
    return level.groupBy("volume_", F.floor(F.col("at") / fanout).alias("at")).agg(
        F.sha2(F.concat_ws(",", said), 256).alias("hash"), F.sum("bytes").alias("bytes")
    )


def audit(one: list[DataFrame], other: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Leaves that differ: (volume_, at, offset, bytes, other_bytes, problem).

    ``problem`` is changed, missing (only in ``one``) or extra (only in ``other``);
    ``offset`` is the leaf's first byte in its replica (of ``one`` unless extra). Trees of
    different heights are compared from the lower one's root level on. Volumes in one
    replica only differ in every leaf. No volumes: no rows.
    """
    height = min(len(one), len(other)) - 1
    differing = None
    for level in range(height, -1, -1):
        a = _started(one[level], differing, fanout, "a")
        b = _started(other[level], differing, fanout, "b")
        found = a.join(
            b, F.col("a_volume").eqNullSafe(F.col("b_volume")) & (F.col("a_at") == F.col("b_at")),
            "full",
        ).filter(~F.col("a_hash").eqNullSafe(F.col("b_hash")))
        in_a = F.col("a_at").isNotNull()
        differing = held(found.select(
            F.when(in_a, F.col("a_volume")).otherwise(F.col("b_volume")).alias("volume_"),
            F.coalesce("a_at", "b_at").alias("at"), "a_start", "b_start", "a_bytes", "b_bytes",
        ), "differing")
    return differing.select(
        "volume_", (F.col("at") - 1).alias("at"),
        F.coalesce("a_start", "b_start").cast("long").alias("offset"),
        F.col("a_bytes").alias("bytes"), F.col("b_bytes").alias("other_bytes"),
        F.when(F.col("b_bytes").isNull(), "missing").when(F.col("a_bytes").isNull(), "extra")
        .otherwise("changed").alias("problem"),
    )


def _started(level: DataFrame, parents: DataFrame | None, fanout: int, side: str) -> DataFrame:
    """The nodes below differing parents, each with the offset of its first byte.

    The offset adds the bytes of earlier siblings to the parent's; at the top, of the
    earlier nodes of the volume.
    """
    nodes = level.withColumn("parent", F.floor(F.col("at") / fanout))
    if parents is None:
        nodes = nodes.withColumn("base", F.lit(0).cast("long"))
        group = W.partitionBy("volume_")
    else:
        above = parents.select(
            F.col("volume_").alias("p_volume"), F.col("at").alias("p_at"),
            F.coalesce(f"{side}_start", F.lit(0)).alias("base"),
        )
        nodes = nodes.join(
            above, F.col("volume_").eqNullSafe(F.col("p_volume")) & (F.col("parent") == F.col("p_at"))
        )
        group = W.partitionBy("volume_", "parent")
    earlier = group.orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    return nodes.select(
        F.col("volume_").alias(f"{side}_volume"), F.col("at").alias(f"{side}_at"),
        (F.col("base") + F.coalesce(F.sum("bytes").over(earlier), F.lit(0))).alias(f"{side}_start"),
        F.col("hash").alias(f"{side}_hash"), F.col("bytes").alias(f"{side}_bytes"),
    )
