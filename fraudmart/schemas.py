"""Canonical schemas of the warehouse.

Every table is typed explicitly; nothing is inferred.  Oracle ``DATE`` carries a
time of day to the second and no zone, so it maps to ``TimestampNTZType``;
``DateType`` would drop the time.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
TS = T.TimestampNTZType()
AMT = T.DecimalType(18, 2)
INT = T.IntegerType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in cols])


CLIENTS = _struct(
    ("client_id", S),
    ("last_name", S),
    ("first_name", S),
    ("patronymic", S),
    ("date_of_birth", TS),
    ("passport_num", S),
    ("passport_valid_to", TS),
    ("phone", S),
    ("create_dt", TS),
    ("update_dt", TS),
)

ACCOUNTS = _struct(
    ("account_num", S),
    ("valid_to", TS),
    ("client", S),
    ("create_dt", TS),
    ("update_dt", TS),
)

CARDS = _struct(
    ("card_num", S),
    ("account_num", S),
    ("create_dt", TS),
    ("update_dt", TS),
)

TERMINALS = _struct(
    ("terminal_id", S),
    ("terminal_type", S),
    ("terminal_city", S),
    ("terminal_address", S),
    ("create_dt", TS),
    ("update_dt", TS),
)

TRANSACTIONS = _struct(
    ("trans_id", S),
    ("trans_date", TS),
    ("card_num", S),
    ("oper_type", S),
    ("amt", AMT),
    ("oper_result", S),
    ("terminal", S),
    ("create_dt", TS),
)

BLACKLIST = _struct(
    ("passport_num", S),
    ("entry_dt", TS),
    ("create_dt", TS),
)

KEY_SNAPSHOT = _struct(("id", S))

META_LOADING = _struct(
    ("db_name", S),
    ("table_name", S),
    ("last_update", TS),
)

REP_FRAUD = _struct(
    ("event_dt", TS),
    ("passport", S),
    ("fio", S),
    ("phone", S),
    ("event_type", INT),
    ("report_dt", TS),
)

# Dimension name -> (schema, business key).  The key is the MERGE/DELETE key.
DIMENSIONS: dict[str, tuple[T.StructType, str]] = {
    "dim_clients": (CLIENTS, "client_id"),
    "dim_accounts": (ACCOUNTS, "account_num"),
    "dim_cards": (CARDS, "card_num"),
    "dim_terminals": (TERMINALS, "terminal_id"),
}

FACTS: dict[str, T.StructType] = {
    "fact_transactions": TRANSACTIONS,
    "fact_passport_blacklist": BLACKLIST,
}

# Dimensions whose rows are hard-deleted when their key leaves the source.
# Terminals are never deleted.
DELETABLE = ("dim_clients", "dim_accounts", "dim_cards")

# Tables that carry a load high-water mark, in seed order.
WATERMARKED = (
    "dim_clients",
    "dim_accounts",
    "dim_cards",
    "dim_terminals",
    "fact_transactions",
    "fact_passport_blacklist",
)

# Report event types.
EVENT_PASSPORT = 1  # passport expired or blacklisted
EVENT_CONTRACT = 2  # account contract expired

# Fixed value: the width of every varchar2 column in the reference DDL.
VARCHAR_LIMIT = 100

# Codec of the Parquet files that the jobs write: smaller than Spark's default.
COMPRESSION = "zstd"

# Source feeds of the daily drop folder: feed -> file name prefix.
FEED_PREFIXES: dict[str, str] = {
    "passport_blacklist": "passport_blacklist",
    "terminals": "terminals",
    "transactions": "transactions",
}

# Positional layout of each file feed (headers are ignored).
TRANSACTIONS_FILE_COLUMNS = ("trans_id", "trans_date", "amt", "card_num", "oper_type", "oper_result", "terminal")
TERMINALS_FILE_COLUMNS = ("terminal_id", "terminal_type", "terminal_city", "terminal_address")
BLACKLIST_FILE_COLUMNS = ("entry_dt", "passport_num")


def columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


def string_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
