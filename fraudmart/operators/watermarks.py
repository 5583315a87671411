"""Load high-water marks (C17, C18, C24; J5, J6, D6).

The control frame has one row per watermarked table, so it is bounded by the
number of tables, never by data.  That bound is what makes collecting a single
watermark to the driver, and broadcasting the per-table maxima, safe.
"""

from __future__ import annotations

import datetime as _dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import change_time, ntz_literal, to_stamp_text

# Fixed value: the seed of every watermark.
SEED_STAMP = "1900-01-01 00:00:00"
DEFAULT_DB = "dwh"


def seed_watermarks(
    spark: SparkSession,
    tables: tuple[str, ...] = schemas.WATERMARKED,
    db_name: str = DEFAULT_DB,
    stamp: str = SEED_STAMP,
) -> DataFrame:
    """One row per table at the seed stamp (``INSERT ... VALUES``)."""
    rows = [(db_name, t) for t in tables]
    return spark.createDataFrame(rows, "db_name string, table_name string").withColumn(
        "last_update", ntz_literal(stamp)
    )


def _lookup(control: DataFrame, table: str, db_name: str | None) -> DataFrame:
    cond = F.col("table_name") == F.lit(table)
    if db_name is not None and "db_name" in control.columns:
        cond = cond & (F.col("db_name") == F.lit(db_name))
    return control.where(cond).select("last_update")


def watermark_value(control: DataFrame, table: str, db_name: str | None = DEFAULT_DB) -> str | None:
    """The watermark as text, or ``None`` when the table has no row.

    More than one row is an error, like a scalar subquery returning many rows.
    """
    rows = _lookup(control, table, db_name).limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"control frame has several watermarks for {table}")
    if not rows or rows[0][0] is None:
        return None
    return to_stamp_text(rows[0][0])


def watermark_values(control: DataFrame, db_name: str | None = DEFAULT_DB) -> dict[str, str | None]:
    """Every watermark of the control frame in one collect (one row per table).

    A table listed twice is an error, as for :func:`watermark_value`.
    """
    rows = control
    if db_name is not None and "db_name" in control.columns:
        rows = rows.where(F.col("db_name") == F.lit(db_name))
    out: dict[str, str | None] = {}
    for r in rows.select("table_name", "last_update").collect():
        if r["table_name"] in out:
            raise ValueError(f"control frame has several watermarks for {r['table_name']}")
        out[r["table_name"]] = None if r["last_update"] is None else to_stamp_text(r["last_update"])
    return out


def watermark_column(control: DataFrame, table: str, db_name: str | None = DEFAULT_DB) -> Column:
    """The watermark as a scalar subquery: evaluated once inside the plan,
    NULL when absent, an error when ambiguous (J5)."""
    return _lookup(control, table, db_name).scalar()


def staged_max(staging: DataFrame, table: str, stamp: Column | None = None, db_name: str = DEFAULT_DB) -> DataFrame:
    """One row ``(db_name, table_name, mx)``: the newest change time in a staging frame.

    Facts use ``create_dt`` (A1); dimensions ``COALESCE(update_dt, create_dt)`` (A2).
    A global ``max`` is a partial aggregate: one small row per task, one final row.
    """
    if stamp is None:
        stamp = change_time() if "update_dt" in staging.columns else F.col("create_dt")
    return staging.agg(F.max(stamp).alias("mx")).select(
        F.lit(db_name).alias("db_name"), F.lit(table).alias("table_name"), "mx"
    )


def advance_watermarks(control: DataFrame, staged: dict[str, DataFrame], db_name: str = DEFAULT_DB) -> DataFrame:
    """Each table's watermark moves to its staged maximum, only when staging is
    non-empty (H22); tables without staging, and those of another database, keep theirs."""
    if not staged:
        return control
    maxima = [staged_max(df, name, db_name=db_name) for name, df in staged.items()]
    news = functools.reduce(DataFrame.unionByName, maxima)
    # ``news`` has one row per staged table: bounded, so broadcasting it is safe.
    joined = control.join(F.broadcast(news), ["db_name", "table_name"], "left")
    out_cols = [c for c in control.columns if c != "last_update"]
    return joined.select(*out_cols, F.coalesce(F.col("mx"), F.col("last_update")).alias("last_update")).select(
        *control.columns
    )


def observed_max(staging: DataFrame) -> Column:
    """The newest change time of a staged frame as text, for an ``Observation`` of the write that stages it (A1, A2)."""
    stamp = change_time() if "update_dt" in staging.columns else F.col("create_dt")
    return F.date_format(F.max(stamp), "yyyy-MM-dd HH:mm:ss")


def advanced_values(known: dict[str, str | None], maxima: dict[str, str | None]) -> dict[str, str | None]:
    """D6 for watermarks and maxima already on the driver (one of each per table): a table
    whose staging was empty keeps its watermark (H22), one without a row gets none (H19)."""
    return {t: (maxima.get(t) or stamp) for t, stamp in known.items()}


def as_of_now() -> str:
    """A stamp for 'now', truncated to seconds (driver clock, one per run)."""
    return to_stamp_text(_dt.datetime.now())
