"""Size check before a broadcast.

A broadcast is only safe below a size that may grow with the data, so it is measured by one
aggregate over the few columns concerned before it is chosen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

# Well under both Spark's 8 GB broadcast limit and a small executor's heap.
BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_when_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a side measured to be small.

    Past the limit the side is returned as it is: Spark then shuffles both sides, and adaptive
    skew handling splits a hot key's partition.
    """
    total = df.agg(F.sum(_row_bytes(df)).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if total <= limit else df


def _row_bytes(df: DataFrame) -> Column:
    return sum((_cell_bytes(f.name, f.dataType) for f in df.schema.fields), F.lit(16))


def _cell_bytes(name: str, kind: DataType) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(kind, StringType):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(kind, NumericType) or kind.typeName().startswith(("timestamp", "date", "bool")):
        return F.lit(8)
    return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)) + 8
