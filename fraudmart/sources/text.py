"""The transactions drop file (S4): ``;``-separated text with a header row.

Columns are bound by *position*; header names are ignored (H10).  Everything is
read as text and typed afterwards: the amount may carry a decimal comma, which
a decimal CSV schema would silently misread (H9); the date keeps its time (F3).
FAILFAST makes a malformed line stop the load instead of dropping it, and a date or
amount that doesn't parse stops it too, whatever the session's ANSI setting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.functions import empty_as_null, parse_amount, parse_oracle_timestamp
from fraudmart.schemas import TRANSACTIONS_FILE_COLUMNS

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in TRANSACTIONS_FILE_COLUMNS])


def read_transactions_raw(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """The file as text columns in file order."""
    return (
        spark.read.schema(schema)
        .option("sep", ";")
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .option("escape", '"')  # a quote inside a quoted field is doubled
        .csv(list(paths) if not isinstance(paths, str) else paths)
    )


def _parsed(name: str, parsed: Column) -> Column:
    """``parsed``, or an error where the column has text that gives NULL."""
    text = F.trim(F.col(name))
    bad = F.raise_error(F.concat(F.lit(f"{name} cannot be read: "), text)).cast(T.NullType())
    return F.when(text.isNotNull() & (text != "") & parsed.isNull(), bad).otherwise(parsed)


def type_transactions(raw: DataFrame, *more: str) -> DataFrame:
    """Text -> typed staging columns (file order kept; capture reorders), then the columns ``more``."""
    return raw.select(
        empty_as_null("trans_id").alias("trans_id"),
        _parsed("trans_date", parse_oracle_timestamp(empty_as_null("trans_date"))).alias("trans_date"),
        _parsed("amt", parse_amount("amt")).alias("amt"),
        empty_as_null("card_num").alias("card_num"),
        empty_as_null("oper_type").alias("oper_type"),
        empty_as_null("oper_result").alias("oper_result"),
        empty_as_null("terminal").alias("terminal"),
        *more,
    )


def read_transactions(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Read and type one or more transactions files."""
    return type_transactions(read_transactions_raw(spark, paths)).select(
        *[F.col(c) for c in TRANSACTIONS_FILE_COLUMNS]
    )


def read_feed_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A terminals or blacklist feed that comes as the same kind of text instead of a workbook.

    Any number of tasks read it, which one workbook can't offer.
    """
    raw = read_transactions_raw(spark, path, T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    typed = []
    for f in schema.fields:
        text = empty_as_null(f.name)
        typed.append((text if isinstance(f.dataType, T.StringType) else _parsed(f.name, parse_oracle_timestamp(text))).alias(f.name))
    return raw.select(*typed)
