"""Driver queries: each operator of the build applied to the fixture scenario.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame built from the
library operators over the whole driver tables; the matching DuckDB text lives
in :mod:`fraudmart.oracle_sql`.  Column names are the same in both.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.fixtures import AS_OF, EMPTY_WATERMARK, LAST_DAY, LOAD_TS, NEXT_DAY, WATERMARK, Fixture
from fraudmart.functions import full_name, ntz_literal
from fraudmart.operators.capture import (
    capture_accounts,
    capture_blacklist,
    capture_cards,
    capture_changed,
    capture_clients,
    capture_terminals,
    capture_transactions,
    initial_load,
    source_keys,
)
from fraudmart.operators.facts import append_facts
from fraudmart.operators.files import oldest_drop, unseen_files
from fraudmart.operators.report import fraud_report, fraud_report_measured, fraud_report_two_pass, rule_contract, rule_passport
from fraudmart.operators.scd1 import missing_keys, scd1_apply, scd1_delete, scd1_upsert
from fraudmart.operators.watermarks import advance_watermarks, seed_watermarks, watermark_column
from fraudmart.plans.catalog import buckets_for
from fraudmart.plans.daily import Warehouse
from fraudmart.session import scratch_path
from fraudmart.sources.layout import write_by_change_date
from fraudmart.sources.tables import read_source
from fraudmart.sources.text import read_transactions

Query = Callable[[SparkSession, str], DataFrame]


# -- capture (C1-C6, J5) ---------------------------------------------------
def q_capture_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_clients(Fixture(spark, sf_dir).clients, WATERMARK)


def q_capture_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_accounts(Fixture(spark, sf_dir).accounts, WATERMARK)


def q_capture_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_cards(Fixture(spark, sf_dir).cards, WATERMARK)


def q_capture_missing_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    # The control frame has no row for the table: the scalar subquery is NULL and
    # nothing is staged.
    control = seed_watermarks(spark, tables=("dim_accounts", "dim_cards"), stamp=WATERMARK)
    wm = watermark_column(control, "dim_clients")
    return capture_changed(fx.clients, wm).select("client_id")


def q_capture_by_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermark as a scalar subquery of the plan."""
    control = seed_watermarks(spark, tables=("dim_clients", "dim_accounts"), stamp=WATERMARK)
    return capture_clients(Fixture(spark, sf_dir).clients, watermark_column(control, "dim_clients"))


def q_capture_terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_terminals(Fixture(spark, sf_dir).terminals, LOAD_TS, WATERMARK)


def q_capture_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_blacklist(Fixture(spark, sf_dir).blacklist, LOAD_TS, WATERMARK)


def q_capture_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_transactions(Fixture(spark, sf_dir).transactions, LOAD_TS, WATERMARK)


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder of the shared scratch space.

    Queries that write tables or drop files put them there when they are called; the result
    reads them later, so they stay until the folder that the cluster names is cleared.
    """
    return scratch_path(spark, "fraudmart-queries", f"{name}-{uuid.uuid4().hex[:12]}")


# -- source tables (S1-S3, J5) -----------------------------------------------
def bank_table(fx: Fixture, name: str) -> DataFrame:
    """A source table as the bank has it: the account key is ``account``, missing text is empty."""
    df = getattr(fx, name)
    texts = [F.coalesce(c, F.lit("")).alias(c) if kind == "string" else F.col(c) for c, kind in df.dtypes]
    return df.select(*texts).withColumnsRenamed({"account_num": "account"})


def _source_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _scratch(spark, name)
        bank_table(Fixture(spark, sf_dir), name).write.parquet(path)
        return read_source(spark, name, path)

    query.__doc__ = f"The bank's ``{name}`` from files through ``read_source``: names, types and empty text conformed."
    return query


def q_capture_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 and R6 over a source kept by change date: folders before the looked-up watermark aren't read."""
    path = _scratch(spark, "clients-by-day")
    write_by_change_date(Fixture(spark, sf_dir).clients, path)
    control = seed_watermarks(spark, tables=("dim_clients", "dim_accounts"), stamp=WATERMARK)
    return capture_clients(read_source(spark, "clients", path), watermark_column(control, "dim_clients"))


def transactions_drop(tx: DataFrame) -> DataFrame:
    """Transactions as the bank's text columns: decimal comma, quotes and separators inside a field."""
    return tx.select(
        "trans_id",
        F.date_format("trans_date", "yyyy-MM-dd HH:mm:ss").alias("trans_date"),
        F.regexp_replace(F.col("amt").cast("string"), r"\.", ",").alias("amount"),
        "card_num",
        F.concat(F.lit('say "'), "oper_type", F.lit(';"')).alias("oper_type"),
        "oper_result",
        "terminal",
    )


def write_drop(df: DataFrame, path: str) -> None:
    """A text drop: ``;``, header, quotes doubled; a folder of part files."""
    df.write.option("sep", ";").option("header", True).option("escape", '"').csv(path)


def q_read_transactions_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 over the whole fact: Spark writes the transactions as the bank's drop file
    (``;``, header, decimal comma, quotes and separators inside a field) into the shared
    scratch folder; the reader binds by position and types it back."""
    path = _scratch(spark, "transactions")
    write_drop(transactions_drop(Fixture(spark, sf_dir).transactions), path)
    return read_transactions(spark, path)


# -- facts (C7, C8) --------------------------------------------------------
def q_append_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = Fixture(spark, sf_dir).transactions
    cut = ntz_literal("1999-01-01")
    return append_facts(tx.where(F.col("trans_date") < cut), tx.where(F.col("trans_date") >= cut))


def q_append_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    bl = Fixture(spark, sf_dir).blacklist
    return append_facts(bl, bl.where(F.col("entry_dt") > ntz_literal("2024-01-20")))


# -- SCD1 upsert (C9-C12) --------------------------------------------------
def q_upsert_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return scd1_upsert(fx.dim_clients_before, capture_clients(fx.clients, WATERMARK), "client_id")


def q_upsert_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return scd1_upsert(fx.dim_accounts_before, capture_accounts(fx.accounts, WATERMARK), "account_num")


def q_upsert_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return scd1_upsert(fx.dim_cards_before, capture_cards(fx.cards, WATERMARK), "card_num")


def q_upsert_terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return scd1_upsert(fx.dim_terminals_before, capture_terminals(fx.terminals, LOAD_TS, WATERMARK), "terminal_id")


# -- key snapshots and deletes (C13-C16, J2) -------------------------------
def q_source_keys_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_keys(Fixture(spark, sf_dir).clients, "client_id")


def q_source_keys_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_keys(Fixture(spark, sf_dir).accounts, "account_num")


def q_source_keys_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_keys(Fixture(spark, sf_dir).cards, "card_num")


def q_missing_keys_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return missing_keys(fx.dim_clients_before, source_keys(fx.left_clients, "client_id"), "client_id")


def q_missing_keys_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return missing_keys(fx.dim_accounts_before, source_keys(fx.left_accounts, "account_num"), "account_num")


def q_missing_keys_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return missing_keys(fx.dim_cards_before, source_keys(fx.left_cards, "card_num"), "card_num")


def q_delete_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return scd1_delete(fx.dim_clients_before, source_keys(fx.left_clients, "client_id"), "client_id")


def q_delete_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return scd1_delete(fx.dim_accounts_before, source_keys(fx.left_accounts, "account_num"), "account_num")


def q_delete_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return scd1_delete(fx.dim_cards_before, source_keys(fx.left_cards, "card_num"), "card_num")


# -- watermarks (C17, C18) -------------------------------------------------
def q_advance_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    control = seed_watermarks(spark, stamp=WATERMARK).union(seed_watermarks(spark, db_name="other", stamp=WATERMARK))
    staged = {
        "dim_clients": capture_clients(fx.clients, WATERMARK),
        "dim_accounts": capture_accounts(fx.accounts, WATERMARK),
        # staged from a later mark: empty, so the watermark must not move
        "dim_cards": capture_cards(fx.cards, EMPTY_WATERMARK),
        "dim_terminals": capture_terminals(fx.terminals, LOAD_TS, WATERMARK),
        "fact_transactions": capture_transactions(fx.transactions, LOAD_TS, WATERMARK),
        "fact_passport_blacklist": capture_blacklist(fx.blacklist, NEXT_DAY, WATERMARK),
    }
    return advance_watermarks(control, staged)


# -- initial load (C23) ----------------------------------------------------
def q_initial_load_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return initial_load(Fixture(spark, sf_dir).clients, schemas.CLIENTS)


def q_initial_load_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return initial_load(Fixture(spark, sf_dir).accounts, schemas.ACCOUNTS)


def q_initial_load_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return initial_load(Fixture(spark, sf_dir).cards, schemas.CARDS)


# -- drop files (S7, S8) ---------------------------------------------------
def drop_file_names(orders: DataFrame) -> DataFrame:
    """A drop-folder listing built from ``orders``: feed by key mod 3, date from
    the order date."""
    feed = F.col("o_orderkey") % 3
    prefix = F.when(feed == 0, "transactions_").when(feed == 1, "terminals_").otherwise("passport_blacklist_")
    suffix = F.when(feed == 0, ".txt").otherwise(".xlsx")
    return orders.select(F.concat(prefix, F.date_format("o_orderdate", "ddMMyyyy"), suffix).alias("name"))


def q_oldest_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oldest_drop(drop_file_names(Fixture(spark, sf_dir).table("orders")))


def q_unseen_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Fixture(spark, sf_dir).table("orders")

    def names(df: DataFrame) -> DataFrame:
        return df.select(F.concat(F.lit("transactions_"), F.col("o_orderkey").cast("string"), F.lit(".txt")).alias("name"))

    ledger = names(orders.where(F.col("o_orderstatus") == "F"))
    return unseen_files(names(orders), ledger)


# -- report (C20-C22, F2) --------------------------------------------------
def q_full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    cl = Fixture(spark, sf_dir).clients
    return cl.select("client_id", full_name("last_name", "first_name", "patronymic").alias("fio"))


def q_fraud_passport(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return rule_passport(fx.clients, fx.accounts, fx.cards, fx.transactions, fx.blacklist, AS_OF)


def q_fraud_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return rule_contract(fx.clients, fx.accounts, fx.cards, fx.transactions, AS_OF)


def q_fraud_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the daily job builds it: flagged cards pinned, measured and broadcast if small."""
    fx = Fixture(spark, sf_dir)
    pin = _scratch(spark, "flagged")
    return fraud_report_measured(fx.clients, fx.accounts, fx.cards, fx.transactions, fx.blacklist, AS_OF, pin)[0]


def q_fraud_report_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C22 over catalog tables with the transactions bucketed by card.

    One load fills the catalog; nothing is broadcast (limit 0), so the flagged cards are shuffled to
    the buckets and the bucketed fact isn't moved.  The buckets grow in number, not in size.
    """
    fx = Fixture(spark, sf_dir)
    database = f"fraudmart_{uuid.uuid4().hex[:12]}"
    wh = Warehouse(spark, _scratch(spark, "catalog"), broadcast_limit_bytes=0, database=database, buckets=buckets_for(fx.transactions.count()))
    sources = {"clients": fx.clients, "accounts": fx.accounts, "cards": fx.cards}
    wh.initial_load(sources)
    wh.increment(sources, {"transactions": fx.transactions, "passport_blacklist": fx.blacklist}, LOAD_TS)
    return wh.report_frame(AS_OF, pin_as=uuid.uuid4().hex[:12])


def q_fraud_report_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The literal shape of C22: rule 1 UNION rule 2 (U1), each branch its own chain."""
    fx = Fixture(spark, sf_dir)
    return fraud_report_two_pass(fx.clients, fx.accounts, fx.cards, fx.transactions, fx.blacklist, AS_OF)


def q_fraud_after_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C19 then C22: capture, upsert and delete all three dimensions, then report."""
    fx = Fixture(spark, sf_dir)
    clients = scd1_apply(
        fx.dim_clients_before,
        capture_clients(fx.left_clients, WATERMARK),
        source_keys(fx.left_clients, "client_id"),
        "client_id",
    )
    accounts = scd1_apply(
        fx.dim_accounts_before,
        capture_accounts(fx.left_accounts, WATERMARK),
        source_keys(fx.left_accounts, "account_num"),
        "account_num",
    )
    cards = scd1_apply(
        fx.dim_cards_before,
        capture_cards(fx.left_cards, WATERMARK),
        source_keys(fx.left_cards, "card_num"),
        "card_num",
    )
    return fraud_report(clients, accounts, cards, fx.transactions, fx.blacklist, AS_OF)


# -- the jobs themselves (C17, C19, C25, S11, S13, S16-S18) ------------------
def loaded_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A scratch warehouse after two days: initial load; day 1 with part of the files and a
    report, which is cleared; day 2 with the rest and changed sources; two reports."""
    fx = Fixture(spark, sf_dir)
    wh = Warehouse(spark, _scratch(spark, "warehouse"))
    wh.initial_load({"clients": fx.dim_clients_before, "accounts": fx.dim_accounts_before, "cards": fx.dim_cards_before})
    early = F.col("trans_date") < ntz_literal("1999-01-01")
    listed = F.col("entry_dt") < ntz_literal("2024-01-20")
    first = {
        "terminals": fx.terminals.withColumn("terminal_city", F.lit("first")),
        "transactions": fx.transactions.where(early),
        "passport_blacklist": fx.blacklist.where(listed),
    }
    wh.increment({"clients": fx.clients, "accounts": fx.accounts, "cards": fx.cards}, first, LOAD_TS)
    wh.build_report(LOAD_TS)
    wh.clear_report()
    rest = {
        "terminals": fx.terminals.where("terminal_type = 'ATM'"),
        "transactions": fx.transactions.where(~early),
        "passport_blacklist": fx.blacklist.where(~listed),
    }
    wh.increment({"clients": fx.next_clients, "accounts": fx.next_accounts, "cards": fx.next_cards}, rest, NEXT_DAY)
    wh.build_report(NEXT_DAY)
    wh.build_report(LAST_DAY)
    return wh


def q_daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C25, the whole day: drop files are written, listed and picked, staged, loaded and published;
    rows that left the sources are deleted; the report is built, published and read back."""
    fx = Fixture(spark, sf_dir)
    drops = _scratch(spark, "drops")
    write_drop(transactions_drop(fx.transactions), f"{drops}/transactions_01012001.txt")
    write_drop(fx.terminals, f"{drops}/terminals_01012001.txt")
    listed = fx.blacklist.select(F.date_format("entry_dt", "yyyy-MM-dd HH:mm:ss").alias("date"), "passport_num")
    write_drop(listed, f"{drops}/passport_blacklist_01012001.txt")
    wh = Warehouse(spark, _scratch(spark, "warehouse"))
    wh.initial_load({"clients": fx.dim_clients_before, "accounts": fx.dim_accounts_before, "cards": fx.dim_cards_before})
    wh.daily_run({"clients": fx.left_clients, "accounts": fx.left_accounts, "cards": fx.left_cards}, drops, LOAD_TS, AS_OF)
    return wh.read_table("rep_fraud")


def _job_query(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return loaded_warehouse(spark, sf_dir).read_table(table)

    return query


QUERIES: dict[str, Query] = {
    "capture_clients": q_capture_clients,
    "capture_accounts": q_capture_accounts,
    "capture_cards": q_capture_cards,
    "capture_missing_watermark": q_capture_missing_watermark,
    "capture_by_lookup": q_capture_by_lookup,
    "capture_by_day": q_capture_by_day,
    **{f"read_source_{name}": _source_query(name) for name in ("clients", "accounts", "cards")},
    "capture_terminals": q_capture_terminals,
    "capture_blacklist": q_capture_blacklist,
    "capture_transactions": q_capture_transactions,
    "read_transactions_text": q_read_transactions_text,
    "append_transactions": q_append_transactions,
    "append_blacklist": q_append_blacklist,
    "upsert_clients": q_upsert_clients,
    "upsert_accounts": q_upsert_accounts,
    "upsert_cards": q_upsert_cards,
    "upsert_terminals": q_upsert_terminals,
    "source_keys_clients": q_source_keys_clients,
    "source_keys_accounts": q_source_keys_accounts,
    "source_keys_cards": q_source_keys_cards,
    "missing_keys_clients": q_missing_keys_clients,
    "missing_keys_accounts": q_missing_keys_accounts,
    "missing_keys_cards": q_missing_keys_cards,
    "delete_clients": q_delete_clients,
    "delete_accounts": q_delete_accounts,
    "delete_cards": q_delete_cards,
    "advance_watermarks": q_advance_watermarks,
    "initial_load_clients": q_initial_load_clients,
    "initial_load_accounts": q_initial_load_accounts,
    "initial_load_cards": q_initial_load_cards,
    "oldest_drop": q_oldest_drop,
    "unseen_files": q_unseen_files,
    "full_name": q_full_name,
    "fraud_passport": q_fraud_passport,
    "fraud_contract": q_fraud_contract,
    "fraud_report": q_fraud_report,
    "fraud_report_union": q_fraud_report_union,
    "fraud_report_bucketed": q_fraud_report_bucketed,
    "daily_run": q_daily_run,
    "fraud_after_increment": q_fraud_after_increment,
    **{f"job_{table}": _job_query(table) for table in (*schemas.DIMENSIONS, *schemas.FACTS, "meta_loading", "rep_fraud")},
}
