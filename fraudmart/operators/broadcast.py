"""Broadcast behind a measured size, with the shuffle join beyond it.

AQE broadcasts a join side only after both sides have been shuffled, so the
large side is always shuffled.  For a side that is pinned (written once and read
back), its exact in-memory size can be measured first: one aggregate over the
pinned rows, summing the bytes each row takes as an unsafe row.  Below the limit
the side is broadcast and the large side is never moved; above it, the plan is
left to the shuffle join (and AQE).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.schemas import COMPRESSION

# An unsafe row: 8-byte null bitset word per 64 fields, 8 bytes per fixed-width
# field, variable-width data rounded up to 8 bytes.  A hashed relation roughly
# doubles that; the factor is applied on top.
_HASHED_RELATION_FACTOR = 2


def _row_bytes(df: DataFrame) -> Column:
    fields = df.schema.fields
    fixed = 8 * ((len(fields) + 63) // 64) + 8 * len(fields)
    expr: Column = F.lit(fixed).cast("long")
    for f in fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            payload = F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
            expr = expr + ((payload + 7) / 8).cast("long") * 8
    return expr


def measured_size(df: DataFrame) -> int:
    """Bytes ``df`` takes in memory as a broadcast hash relation (one small job)."""
    row = df.agg(F.sum(_row_bytes(df)).alias("b")).collect()[0]
    return int(row["b"] or 0) * _HASHED_RELATION_FACTOR


def observed_size(df: DataFrame) -> Column:
    """The same as an aggregate, for an ``Observation`` of the write that pins ``df``: no job of its own."""
    return F.coalesce(F.sum(_row_bytes(df)), F.lit(0).cast("long")) * _HASHED_RELATION_FACTOR


def pinned_broadcast(df: DataFrame, path: str, limit_bytes: int) -> tuple[DataFrame, int]:
    """``df`` written once to ``path`` and read back, with a broadcast hint if it fits; and its size, measured by the write."""
    size = Observation()
    df.observe(size, observed_size(df).alias("bytes")).write.mode("errorifexists").option("compression", COMPRESSION).parquet(path)
    pinned, measured = df.sparkSession.read.schema(df.schema).parquet(path), int(size.get["bytes"])
    return (F.broadcast(pinned) if measured <= limit_bytes else pinned), measured


def broadcast_if_small(df: DataFrame, limit_bytes: int) -> tuple[DataFrame, int]:
    """``(broadcast(df), size)`` when the measured size fits, else ``(df, size)``.

    ``df`` should be pinned, so the measurement and the join read the same rows.
    """
    size = measured_size(df)
    return (F.broadcast(df) if size <= limit_bytes else df), size
