"""Rows packed as text, for processors that pass them on without looking inside.

Columns keep their exact types this way: nothing becomes a float because a pandas
column has nulls, and state schemas stay the same whatever the rows hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def pack(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), OPTIONS)


def unpack(text: Column, schema: T.StructType) -> Column:
    return F.from_json(text, schema, {**OPTIONS, "mode": "FAILFAST"})
