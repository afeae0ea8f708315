"""Size checks made before a side is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# At a few hundred bytes a row this stays in the tens of megabytes.
BROADCAST_ROWS = 100_000


BROADCAST_BYTES = 64 << 20


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Compare the number of rows and the bytes of their text, also inside structs, to the bounds."""
    leaves = _leaves(df.schema)
    texts = [
        F.octet_length(path) for path, kind in leaves if isinstance(kind, (T.StringType, T.BinaryType))
    ]
    width = sum((F.coalesce(text, F.lit(0)) for text in texts), F.lit(8 * len(leaves)))
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def _leaves(schema: T.StructType, above: str = "") -> list[tuple[str, T.DataType]]:
    """Paths and types of all columns, with structs taken apart."""
    found = []
    for field in schema.fields:
        path = f"{above}`{field.name}`"
        if isinstance(field.dataType, T.StructType):
            found += _leaves(field.dataType, f"{path}.")
        else:
            found.append((path, field.dataType))
    return found
