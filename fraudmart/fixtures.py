"""Warehouse-shaped frames derived from the driver tables.

The reference ships no data, so the driver's TPC-H-like tables are reshaped into
the banking model (see FIXTURES.md section 3):

    clients <- customer, accounts <- orders, cards <- orders (one card each),
    transactions <- lineitem, blacklist <- error events, terminals <- supplier.

The tables themselves are "the source today"; ``left_*`` lacks every 11th row (keys that
left the source, for the deletes); ``*_before`` is the dimension before the load (every
5th row not yet loaded, one column stale); ``next_*`` is the source a day later.  The expressions are the same
text as the DuckDB oracle views, so both engines see identical inputs.
"""

from __future__ import annotations

import functools
import os

from pyspark.sql import DataFrame, SparkSession

# Fixed instants of the fixture scenario.
WATERMARK = "1997-06-01 00:00:00"
LOAD_TS = "2001-01-01 00:00:00"
AS_OF = "2001-01-01 00:00:00"
EMPTY_WATERMARK = "2099-01-01 00:00:00"
NEXT_DAY = "2001-01-02 00:00:00"
LAST_DAY = "2001-01-03 00:00:00"
CHANGED = "2010-01-01 00:00:00"  # later than every stamp of the tables

CLIENTS_EXPR = [
    "CAST(c_custkey AS STRING) client_id",
    "c_name last_name",
    "c_mktsegment first_name",
    "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE concat('N', CAST(c_nationkey AS STRING)) END patronymic",
    "CAST(date_add(DATE'1960-01-01', CAST(c_custkey % 14600 AS INT)) AS TIMESTAMP_NTZ) date_of_birth",
    "concat('P', CAST(c_custkey AS STRING)) passport_num",
    "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE "
    "CAST(date_add(DATE'1999-01-01', CAST((c_custkey * 37) % 2000 AS INT)) AS TIMESTAMP_NTZ) END passport_valid_to",
    "concat('+7', lpad(CAST(c_custkey AS STRING), 10, '0')) phone",
    "CAST(date_add(DATE'1995-01-01', CAST(c_custkey % 365 AS INT)) AS TIMESTAMP_NTZ) create_dt",
    "CASE WHEN c_custkey % 3 = 0 THEN "
    "CAST(date_add(DATE'1997-01-01', CAST(c_custkey % 1000 AS INT)) AS TIMESTAMP_NTZ) ELSE NULL END update_dt",
]

ACCOUNTS_EXPR = [
    "CAST(o_orderkey AS STRING) account_num",
    "o_orderdate + INTERVAL '730' DAY valid_to",
    "CAST(o_custkey AS STRING) client",
    "o_orderdate create_dt",
    "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '30' DAY ELSE NULL END update_dt",
]

CARDS_EXPR = [
    "concat('C', CAST(o_orderkey AS STRING)) card_num",
    "CAST(o_orderkey AS STRING) account_num",
    "o_orderdate create_dt",
    "CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL '30' DAY ELSE NULL END update_dt",
]

TRANSACTIONS_EXPR = [
    "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) trans_id",
    "l_shipdate trans_date",
    "concat('C', CAST(l_orderkey AS STRING)) card_num",
    "l_returnflag oper_type",
    "CAST(l_extendedprice AS DECIMAL(18,2)) amt",
    "l_linestatus oper_result",
    "CAST(l_suppkey AS STRING) terminal",
]

BLACKLIST_EXPR = [
    "concat('P', CAST(user_id AS STRING)) passport_num",
    "ts entry_dt",
]
BLACKLIST_WHERE = "event_type = 'error'"

TERMINALS_EXPR = [
    "CAST(s_suppkey AS STRING) terminal_id",
    "CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END terminal_type",
    "CAST(s_nationkey AS STRING) terminal_city",
    "s_name terminal_address",
]


class Fixture:
    """Lazily built fixture frames for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    # -- banking model -------------------------------------------------
    @functools.cached_property
    def clients(self) -> DataFrame:
        return self.table("customer").selectExpr(*CLIENTS_EXPR)

    @functools.cached_property
    def accounts(self) -> DataFrame:
        return self.table("orders").selectExpr(*ACCOUNTS_EXPR)

    @functools.cached_property
    def cards(self) -> DataFrame:
        return self.table("orders").selectExpr(*CARDS_EXPR)

    @functools.cached_property
    def transactions(self) -> DataFrame:
        return self.table("lineitem").selectExpr(*TRANSACTIONS_EXPR)

    @functools.cached_property
    def blacklist(self) -> DataFrame:
        return self.table("events").where(BLACKLIST_WHERE).selectExpr(*BLACKLIST_EXPR)

    @functools.cached_property
    def terminals(self) -> DataFrame:
        return self.table("supplier").selectExpr(*TERMINALS_EXPR)

    # -- source today / dimension before the load ------------------------
    # The sources are the whole tables; ``left_*`` are sources that some rows have
    # left, for the operators that look for missing keys.
    @functools.cached_property
    def left_clients(self) -> DataFrame:
        return self.clients.where("CAST(client_id AS BIGINT) % 11 <> 0")

    @functools.cached_property
    def left_accounts(self) -> DataFrame:
        return self.accounts.where("CAST(account_num AS BIGINT) % 11 <> 0")

    @functools.cached_property
    def left_cards(self) -> DataFrame:
        return self.cards.where("CAST(account_num AS BIGINT) % 11 <> 0")

    @functools.cached_property
    def dim_clients_before(self) -> DataFrame:
        stale = ["'stale' phone" if c == "phone" else c for c in self.clients.columns]
        return self.clients.where("CAST(client_id AS BIGINT) % 5 <> 0").selectExpr(*stale)

    @functools.cached_property
    def dim_accounts_before(self) -> DataFrame:
        return self.accounts.where("CAST(account_num AS BIGINT) % 5 <> 0").selectExpr(
            "account_num", "create_dt valid_to", "client", "create_dt", "update_dt"
        )

    @functools.cached_property
    def dim_cards_before(self) -> DataFrame:
        return self.cards.where("CAST(account_num AS BIGINT) % 5 <> 0").selectExpr(
            "card_num", "'-1' account_num", "create_dt", "update_dt"
        )

    @functools.cached_property
    def dim_terminals_before(self) -> DataFrame:
        return self.terminals.where("CAST(terminal_id AS BIGINT) % 5 <> 0").selectExpr(
            "terminal_id",
            "terminal_type",
            "'stale' terminal_city",
            "terminal_address",
            "TIMESTAMP_NTZ'1995-01-01 00:00:00' create_dt",
            "TIMESTAMP_NTZ'1996-01-01 00:00:00' update_dt",
        )

    # -- the next day: some rows changed, some left, some changed without a new stamp
    @functools.cached_property
    def next_clients(self) -> DataFrame:
        return self.clients.where("CAST(client_id AS BIGINT) % 13 <> 0").selectExpr(*next_day(self.clients.columns, "client_id", "phone"))

    @functools.cached_property
    def next_accounts(self) -> DataFrame:
        return self.accounts.where("CAST(account_num AS BIGINT) % 13 <> 0").selectExpr(
            *next_day(self.accounts.columns, "account_num", "client")
        )

    @functools.cached_property
    def next_cards(self) -> DataFrame:
        return self.cards.where("CAST(account_num AS BIGINT) % 13 <> 0")


def next_day(columns: list[str], key: str, changed: str) -> list[str]:
    """Every fourth key has a new value and stamp, the one after it a new value under its old stamp."""
    rest = f"CAST({key} AS BIGINT) % 4"
    new = {
        changed: f"CASE {rest} WHEN 0 THEN 'new' WHEN 1 THEN 'unstamped' ELSE {changed} END {changed}",
        "update_dt": f"CASE WHEN {rest} = 0 THEN TIMESTAMP_NTZ'{CHANGED}' ELSE update_dt END update_dt",
    }
    return [new.get(c, c) for c in columns]
