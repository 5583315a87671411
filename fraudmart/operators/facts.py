"""Append-only facts.

Facts are never deduplicated: loading the same file twice duplicates it (H25).
Storage makes a *rerun* of one batch safe by overwriting that batch's partition
(see :mod:`fraudmart.plans.store`); the operator itself is UNION ALL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_facts(existing: DataFrame, staged: DataFrame) -> DataFrame:
    """``INSERT INTO fact SELECT * FROM staging``: UNION ALL, no dedup."""
    return existing.unionByName(staged.select(*existing.columns))


def with_batch(staged: DataFrame, batch_id: int) -> DataFrame:
    """Tag staged fact rows with the batch that loaded them (partition column)."""
    return staged.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
