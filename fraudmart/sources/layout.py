"""Source tables kept by change date, so that an increment reads only the days after its watermark.

A source written by ``write_by_change_date`` has one folder for each day of ``COALESCE(update_dt,
create_dt)``; ``operators.capture`` then adds a condition on that column, which prunes folders, also when
the watermark is a scalar subquery that is known only at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.functions import change_time

CHANGE_DATE = "change_date"


def change_date() -> Column:
    """The day of a row's newest stamp; NULL if it has none (such a row is never captured, H21)."""
    return change_time().cast("date")


def write_by_change_date(source: DataFrame, path: str) -> None:
    """Write a source table in folders by change date; rows of a day are dealt over several tasks' files."""
    source.withColumn(CHANGE_DATE, change_date()).write.mode("errorifexists").partitionBy(CHANGE_DATE).parquet(path)
