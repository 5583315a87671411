"""Source tables of the bank (S1-S3): clients, accounts, cards.

Read from parquet (the default) or over JDBC with a partitioned read, so a large
source is pulled by many tasks in parallel instead of one connection.  Columns are
projected to the canonical schema (``account`` -> ``account_num``) and cast, and
Oracle's empty-string-is-NULL rule is applied to text (H3).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart import schemas
from fraudmart.functions import empty_as_null
from fraudmart.sources.layout import CHANGE_DATE

SOURCE_SCHEMAS: dict[str, tuple[T.StructType, str]] = {
    "clients": (schemas.CLIENTS, "client_id"),
    "accounts": (schemas.ACCOUNTS, "account_num"),
    "cards": (schemas.CARDS, "card_num"),
}

# The bank names the account key ``account`` in both tables.
SOURCE_RENAMES: dict[str, dict[str, str]] = {
    "accounts": {"account": "account_num"},
    "cards": {"account": "account_num"},
}


@dataclass(frozen=True)
class JdbcSource:
    """A database table, read in ``partitions`` ranges of a numeric or date column (one query per task).

    The column and its bounds are required: without them one task would read the
    whole table.  Dates come without a zone, so no session zone can shift them.
    """

    url: str
    table: str
    partition_column: str
    lower_bound: str
    upper_bound: str
    partitions: int = 64
    fetch_size: int = 10_000
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        if not (self.partition_column and self.lower_bound and self.upper_bound):
            raise ValueError(f"{self.table}: a partition column with bounds is required")
        return {
            **self.properties,
            "url": self.url,
            "dbtable": self.table,
            "partitionColumn": self.partition_column,
            "lowerBound": str(self.lower_bound),
            "upperBound": str(self.upper_bound),
            "numPartitions": str(self.partitions),
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
        }


def conform(df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename, cast to the canonical types and turn empty text into NULL."""
    for old, new in (renames or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    cols = []
    for field in schema.fields:
        c = F.col(field.name).cast(field.dataType)
        if isinstance(field.dataType, T.StringType):
            c = empty_as_null(c)
        cols.append(c.alias(field.name))
    if CHANGE_DATE in df.columns:  # a folder's column: capture prunes by it
        cols.append(F.col(CHANGE_DATE))
    return df.select(*cols)


def read_source(
    spark: SparkSession,
    name: str,
    path: str | None = None,
    fmt: str = "parquet",
    jdbc: JdbcSource | None = None,
) -> DataFrame:
    """Read one source table as a conformed DataFrame, from files or over JDBC."""
    schema, _key = SOURCE_SCHEMAS[name]
    if jdbc:
        df = spark.read.format("jdbc").options(**jdbc.options()).load()
    else:
        if path is None:
            raise ValueError(f"source {name}: give a path or a database table")
        df = spark.read.format(fmt).load(path)
    return conform(df, schema, SOURCE_RENAMES.get(name))
