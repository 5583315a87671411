"""Change capture into staging.

Only rows whose change time is *strictly* newer than the table's high-water mark
are staged (H20).  A missing watermark is NULL, and ``x > NULL`` selects nothing
(H19); a row whose both stamps are NULL is never captured (H21).

Pass the watermark as a literal (collected from the bounded control frame) to let
the comparison reach the parquet scan as a pushed filter; a ``Column`` (e.g. a
scalar subquery from :func:`fraudmart.operators.watermarks.watermark_column`)
keeps the lookup inside the plan instead.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import as_ntz, change_time
from fraudmart.sources.layout import CHANGE_DATE

Stamp = str | _dt.datetime | _dt.date | Column | None


def capture_changed(source: DataFrame, watermark: Stamp) -> DataFrame:
    """Rows with ``COALESCE(update_dt, create_dt) > watermark``.

    ``COALESCE(u, c) > w`` implies ``u > w OR c > w``; that weaker, redundant
    predicate is pushable, so parquet skips row groups (and files) whose stamps
    are all old: an increment over a large, time-ordered source reads only its
    recent part.  A source kept by change date (:mod:`fraudmart.sources.layout`) is
    pruned by folder, whether the watermark is a literal or a subquery of the plan.
    """
    wm = as_ntz(watermark)
    prune = (F.col("update_dt") > wm) | (F.col("create_dt") > wm)
    if CHANGE_DATE in source.columns:
        source = source.where(F.col(CHANGE_DATE) >= wm.cast("date"))
    return source.where(prune & (change_time() > wm))


def capture_clients(source: DataFrame, watermark: Stamp) -> DataFrame:
    """All client columns, same names in source and staging."""
    return capture_changed(source, watermark).select(*schemas.columns(schemas.CLIENTS))


def _rename_account(source: DataFrame) -> DataFrame:
    # The bank's tables call the account key ``account``; the warehouse ``account_num``.
    if "account" in source.columns and "account_num" not in source.columns:
        return source.withColumnRenamed("account", "account_num")
    return source


def capture_accounts(source: DataFrame, watermark: Stamp) -> DataFrame:
    """``account`` -> ``account_num``."""
    return capture_changed(_rename_account(source), watermark).select(*schemas.columns(schemas.ACCOUNTS))


def capture_cards(source: DataFrame, watermark: Stamp) -> DataFrame:
    """``account`` -> ``account_num``."""
    return capture_changed(_rename_account(source), watermark).select(*schemas.columns(schemas.CARDS))


def _file_gate(feed: DataFrame, load_ts: Stamp, watermark: Stamp) -> DataFrame:
    """File rows carry no change time: the reference gates the whole file on
    ``sysdate > last_update`` (H24) and stamps every row with the load time."""
    return feed.where(as_ntz(load_ts) > as_ntz(watermark))


def capture_terminals(feed: DataFrame, load_ts: Stamp, watermark: Stamp) -> DataFrame:
    """C4: id, type, city, address; ``create_dt`` = load time, ``update_dt`` NULL."""
    gated = _file_gate(feed, load_ts, watermark)
    return gated.select(
        *schemas.TERMINALS_FILE_COLUMNS,
        as_ntz(load_ts).alias("create_dt"),
        F.lit(None).cast("timestamp_ntz").alias("update_dt"),
    )


def capture_blacklist(feed: DataFrame, load_ts: Stamp, watermark: Stamp) -> DataFrame:
    """Passport, entry date, load time (the file has date first)."""
    gated = _file_gate(feed, load_ts, watermark)
    return gated.select("passport_num", "entry_dt", as_ntz(load_ts).alias("create_dt"))


def capture_transactions(feed: DataFrame, load_ts: Stamp, watermark: Stamp, *more: str) -> DataFrame:
    """The seven file columns in warehouse order, plus the load time and the columns ``more``."""
    gated = _file_gate(feed, load_ts, watermark)
    return gated.select(
        "trans_id",
        "trans_date",
        "card_num",
        "oper_type",
        F.col("amt").cast(schemas.AMT).alias("amt"),
        "oper_result",
        "terminal",
        as_ntz(load_ts).alias("create_dt"),
        *more,
    )


def source_keys(source: DataFrame, key: str) -> DataFrame:
    """The full key snapshot of a source table (not watermark-filtered)."""
    if key == "account_num":
        source = _rename_account(source)
    return source.select(F.col(key).alias("id"))


def initial_load(source: DataFrame, schema) -> DataFrame:
    """Full copy of a source table into an empty dimension."""
    return _rename_account(source).select(*schemas.columns(schema))
