"""DuckDB oracle SQL for every driver query.

The driver registers only the raw tables, so the fixture views (FIXTURES.md
section 3) are inlined as CTEs in front of each statement.  The statements are
written independently of the Spark operators: plain SQL with LEFT JOIN ... IS
NULL, IN, NOT EXISTS, UNION, MERGE/DELETE expressed as set algebra.
"""

from __future__ import annotations

import re

NTZ = "TIMESTAMP"

# name -> DuckDB view body.  Order is a valid dependency order.
VIEWS: dict[str, str] = {
    "clients": (
        "SELECT CAST(c_custkey AS STRING) client_id, c_name last_name, c_mktsegment first_name, "
        "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE concat('N', CAST(c_nationkey AS STRING)) END patronymic, "
        "CAST(DATE '1960-01-01' + CAST(c_custkey % 14600 AS INTEGER) AS TIMESTAMP) date_of_birth, "
        "concat('P', CAST(c_custkey AS STRING)) passport_num, "
        "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE "
        "CAST(DATE '1999-01-01' + CAST((c_custkey * 37) % 2000 AS INTEGER) AS TIMESTAMP) END passport_valid_to, "
        "concat('+7', lpad(CAST(c_custkey AS STRING), 10, '0')) phone, "
        "CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) create_dt, "
        "CASE WHEN c_custkey % 3 = 0 THEN CAST(DATE '1997-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS TIMESTAMP) "
        "ELSE NULL END update_dt FROM customer"
    ),
    "accounts": (
        "SELECT CAST(o_orderkey AS STRING) account_num, o_orderdate + INTERVAL '730' DAY valid_to, "
        "CAST(o_custkey AS STRING) client, o_orderdate create_dt, "
        "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '30' DAY ELSE NULL END update_dt FROM orders"
    ),
    "cards": (
        "SELECT concat('C', CAST(o_orderkey AS STRING)) card_num, CAST(o_orderkey AS STRING) account_num, "
        "o_orderdate create_dt, "
        "CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL '30' DAY ELSE NULL END update_dt FROM orders"
    ),
    "transactions": (
        "SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) trans_id, "
        "l_shipdate trans_date, concat('C', CAST(l_orderkey AS STRING)) card_num, l_returnflag oper_type, "
        "CAST(l_extendedprice AS DECIMAL(18,2)) amt, l_linestatus oper_result, "
        "CAST(l_suppkey AS STRING) terminal FROM lineitem"
    ),
    "blacklist": (
        "SELECT concat('P', CAST(user_id AS STRING)) passport_num, ts entry_dt FROM events "
        "WHERE event_type = 'error'"
    ),
    "terminals": (
        "SELECT CAST(s_suppkey AS STRING) terminal_id, "
        "CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END terminal_type, "
        "CAST(s_nationkey AS STRING) terminal_city, s_name terminal_address FROM supplier"
    ),
    "left_clients": "SELECT * FROM clients WHERE CAST(client_id AS BIGINT) % 11 <> 0",
    "left_accounts": "SELECT * FROM accounts WHERE CAST(account_num AS BIGINT) % 11 <> 0",
    "left_cards": "SELECT * FROM cards WHERE CAST(account_num AS BIGINT) % 11 <> 0",
    "dim_clients_before": (
        "SELECT * REPLACE ('stale' AS phone) FROM clients WHERE CAST(client_id AS BIGINT) % 5 <> 0"
    ),
    "dim_accounts_before": (
        "SELECT account_num, create_dt valid_to, client, create_dt, update_dt FROM accounts "
        "WHERE CAST(account_num AS BIGINT) % 5 <> 0"
    ),
    "dim_cards_before": (
        "SELECT card_num, '-1' account_num, create_dt, update_dt FROM cards WHERE CAST(account_num AS BIGINT) % 5 <> 0"
    ),
    "dim_terminals_before": (
        "SELECT terminal_id, terminal_type, 'stale' terminal_city, terminal_address, "
        "TIMESTAMP '1995-01-01 00:00:00' create_dt, TIMESTAMP '1996-01-01 00:00:00' update_dt FROM terminals "
        "WHERE CAST(terminal_id AS BIGINT) % 5 <> 0"
    ),
    "stg_terminals": (
        "SELECT *, TIMESTAMP '2001-01-01 00:00:00' create_dt, CAST(NULL AS TIMESTAMP) update_dt FROM terminals"
    ),
    # after the job's second day: changed rows as of that day, those without a new stamp as of the first
    "job_clients": (
        "SELECT * REPLACE (CASE WHEN CAST(client_id AS BIGINT) % 4 = 0 THEN 'new' ELSE phone END AS phone, "
        "CASE WHEN CAST(client_id AS BIGINT) % 4 = 0 THEN TIMESTAMP '2010-01-01 00:00:00' ELSE update_dt END AS update_dt) "
        "FROM clients WHERE CAST(client_id AS BIGINT) % 13 <> 0"
    ),
    "job_accounts": (
        "SELECT * REPLACE (CASE WHEN CAST(account_num AS BIGINT) % 4 = 0 THEN 'new' ELSE client END AS client, "
        "CASE WHEN CAST(account_num AS BIGINT) % 4 = 0 THEN TIMESTAMP '2010-01-01 00:00:00' ELSE update_dt END AS update_dt) "
        "FROM accounts WHERE CAST(account_num AS BIGINT) % 13 <> 0"
    ),
    "job_cards": "SELECT * FROM cards WHERE CAST(account_num AS BIGINT) % 13 <> 0",
}

WM = f"{NTZ} '1997-06-01 00:00:00'"
LOAD = f"{NTZ} '2001-01-01 00:00:00'"
ASOF = f"{NTZ} '2001-01-01 00:00:00'"
FIO = "concat(coalesce({p}last_name, ''), ' ', coalesce({p}first_name, ''), ' ', coalesce({p}patronymic, ''))"

_CHAIN = (
    "FROM {c} c LEFT JOIN {a} a ON c.client_id = a.client LEFT JOIN {k} k ON a.account_num = k.account_num "
    "LEFT JOIN transactions t ON t.card_num = k.card_num WHERE t.trans_id IS NOT NULL AND "
)


def _rule(event_type: int, cond: str, c: str = "clients", a: str = "accounts", k: str = "cards") -> str:
    return (
        f"SELECT t.trans_date event_dt, c.passport_num passport, {FIO.format(p='c.')} fio, c.phone phone, "
        f"{event_type} event_type, {ASOF} report_dt " + _CHAIN.format(c=c, a=a, k=k) + cond
    )


RULE1_COND = f"(c.passport_valid_to < {ASOF} OR c.passport_num IN (SELECT passport_num FROM blacklist))"
RULE2_COND = f"a.valid_to < {ASOF}"


def _upsert(target: str, staging: str, key: str) -> str:
    return (
        f"SELECT t.* FROM {target} t LEFT JOIN {staging} g ON t.{key} = g.{key} WHERE g.{key} IS NULL "
        f"UNION ALL SELECT * FROM {staging}"
    )


def _delete(target: str, source: str, key: str) -> str:
    missing = f"SELECT t.{key} FROM {target} t LEFT JOIN {source} s ON t.{key} = s.{key} WHERE s.{key} IS NULL"
    return f"SELECT * FROM {target} d WHERE NOT COALESCE(d.{key} IN ({missing}), false)"


def _stg(source: str, wm: str = WM) -> str:
    return f"SELECT * FROM {source} WHERE COALESCE(update_dt, create_dt) > {wm}"


_INCREMENT_CTES = (
    f"c_stg AS ({_stg('left_clients')}), c_up AS ({_upsert('dim_clients_before', 'c_stg', 'client_id')}), "
    "c_new AS (SELECT * FROM c_up u WHERE u.client_id IS NULL OR u.client_id IN (SELECT client_id FROM left_clients)), "
    f"a_stg AS ({_stg('left_accounts')}), a_up AS ({_upsert('dim_accounts_before', 'a_stg', 'account_num')}), "
    "a_new AS (SELECT * FROM a_up u WHERE u.account_num IS NULL OR u.account_num IN (SELECT account_num FROM left_accounts)), "
    f"k_stg AS ({_stg('left_cards')}), k_up AS ({_upsert('dim_cards_before', 'k_stg', 'card_num')}), "
    "k_new AS (SELECT * FROM k_up u WHERE u.card_num IS NULL OR u.card_num IN (SELECT card_num FROM left_cards))"
)

_FILES = (
    "files AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'transactions_' WHEN 1 THEN 'terminals_' "
    "ELSE 'passport_blacklist_' END || strftime(o_orderdate, '%d%m%Y') || "
    "CASE o_orderkey % 3 WHEN 0 THEN '.txt' ELSE '.xlsx' END AS name FROM orders), "
    "dated AS (SELECT CASE WHEN starts_with(name, 'passport_blacklist') THEN 'passport_blacklist' "
    "WHEN starts_with(name, 'terminals') THEN 'terminals' WHEN starts_with(name, 'transactions') THEN 'transactions' "
    "END AS feed, name, CAST(strptime(regexp_extract(name, '(\\d{8})\\.', 1), '%d%m%Y') AS DATE) AS drop_date "
    "FROM files), firsts AS (SELECT feed, min(drop_date) AS drop_date FROM dated WHERE feed IS NOT NULL GROUP BY feed)"
)

_NEW_MARKS = (
    f"SELECT 'dim_clients' table_name, MAX(COALESCE(update_dt, create_dt)) mx FROM clients WHERE COALESCE(update_dt, create_dt) > {WM} "
    f"UNION ALL SELECT 'dim_accounts', MAX(COALESCE(update_dt, create_dt)) FROM accounts WHERE COALESCE(update_dt, create_dt) > {WM} "
    f"UNION ALL SELECT 'dim_cards', MAX(COALESCE(update_dt, create_dt)) FROM cards "
    f"WHERE COALESCE(update_dt, create_dt) > {NTZ} '2099-01-01 00:00:00' "
    f"UNION ALL SELECT 'dim_terminals', MAX({LOAD}) FROM terminals UNION ALL SELECT 'fact_transactions', MAX({LOAD}) FROM transactions "
    f"UNION ALL SELECT 'fact_passport_blacklist', MAX({NTZ} '2001-01-02 00:00:00') FROM blacklist"
)
_TABLES = ("dim_clients", "dim_accounts", "dim_cards", "dim_terminals", "fact_transactions", "fact_passport_blacklist")
_WATERMARKS = (
    f"SELECT db_name, w.table_name, CASE WHEN db_name = 'dwh' THEN COALESCE(mx, {WM}) ELSE {WM} END last_update "
    f"FROM (SELECT unnest({list(_TABLES)!r}) table_name) w CROSS JOIN (VALUES ('dwh'), ('other')) d(db_name) "
    f"LEFT JOIN ({_NEW_MARKS}) m ON w.table_name = m.table_name"
)

STATEMENTS: dict[str, str] = {
    "capture_clients": _stg("clients"),
    "capture_by_lookup": _stg("clients"),
    "capture_by_day": _stg("clients"),
    "read_source_clients": "SELECT * FROM clients",
    "read_source_accounts": "SELECT * FROM accounts",
    "read_source_cards": "SELECT * FROM cards",
    "capture_accounts": _stg("accounts"),
    "capture_cards": _stg("cards"),
    "capture_missing_watermark": "SELECT client_id FROM clients WHERE COALESCE(update_dt, create_dt) > "
    "(SELECT create_dt FROM clients WHERE client_id = 'none')",
    "capture_terminals": f"SELECT terminal_id, terminal_type, terminal_city, terminal_address, {LOAD} create_dt, "
    f"CAST(NULL AS TIMESTAMP) update_dt FROM terminals WHERE {LOAD} > {WM}",
    "capture_blacklist": f"SELECT passport_num, entry_dt, {LOAD} create_dt FROM blacklist WHERE {LOAD} > {WM}",
    "capture_transactions": f"SELECT trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal, "
    f"{LOAD} create_dt FROM transactions WHERE {LOAD} > {WM}",
    "read_transactions_text": "SELECT trans_id, trans_date, amt, card_num, 'say \"' || oper_type || ';\"' oper_type, "
    "oper_result, terminal FROM transactions",
    "append_transactions": f"SELECT * FROM transactions WHERE trans_date < {NTZ} '1999-01-01 00:00:00' "
    f"UNION ALL SELECT * FROM transactions WHERE trans_date >= {NTZ} '1999-01-01 00:00:00'",
    "append_blacklist": f"SELECT * FROM blacklist UNION ALL SELECT * FROM blacklist "
    f"WHERE entry_dt > {NTZ} '2024-01-20 00:00:00'",
    "upsert_clients": f"WITH stg AS ({_stg('clients')}) " + _upsert("dim_clients_before", "stg", "client_id"),
    "upsert_accounts": f"WITH stg AS ({_stg('accounts')}) " + _upsert("dim_accounts_before", "stg", "account_num"),
    "upsert_cards": f"WITH stg AS ({_stg('cards')}) " + _upsert("dim_cards_before", "stg", "card_num"),
    "upsert_terminals": _upsert("dim_terminals_before", "stg_terminals", "terminal_id"),
    "source_keys_clients": "SELECT client_id id FROM clients",
    "source_keys_accounts": "SELECT account_num id FROM accounts",
    "source_keys_cards": "SELECT card_num id FROM cards",
    "missing_keys_clients": "SELECT t.client_id FROM dim_clients_before t LEFT JOIN left_clients s "
    "ON t.client_id = s.client_id WHERE s.client_id IS NULL",
    "missing_keys_accounts": "SELECT t.account_num FROM dim_accounts_before t LEFT JOIN left_accounts s "
    "ON t.account_num = s.account_num WHERE s.account_num IS NULL",
    "missing_keys_cards": "SELECT t.card_num FROM dim_cards_before t LEFT JOIN left_cards s "
    "ON t.card_num = s.card_num WHERE s.card_num IS NULL",
    "delete_clients": _delete("dim_clients_before", "left_clients", "client_id"),
    "delete_accounts": _delete("dim_accounts_before", "left_accounts", "account_num"),
    "delete_cards": _delete("dim_cards_before", "left_cards", "card_num"),
    "advance_watermarks": _WATERMARKS,
    "initial_load_clients": "SELECT * FROM clients",
    "initial_load_accounts": "SELECT * FROM accounts",
    "initial_load_cards": "SELECT * FROM cards",
    "oldest_drop": f"WITH {_FILES} SELECT d.feed, min(d.name) AS name, d.drop_date FROM dated d "
    "JOIN firsts f ON d.feed = f.feed AND d.drop_date = f.drop_date GROUP BY d.feed, d.drop_date",
    "unseen_files": "SELECT concat('transactions_', CAST(o_orderkey AS STRING), '.txt') name FROM orders o "
    "WHERE NOT EXISTS (SELECT 1 FROM orders d WHERE d.o_orderkey = o.o_orderkey AND d.o_orderstatus = 'F')",
    "full_name": f"SELECT client_id, {FIO.format(p='')} fio FROM clients",
    "fraud_passport": "SELECT DISTINCT * FROM (" + _rule(1, RULE1_COND) + ")",
    "fraud_contract": "SELECT DISTINCT * FROM (" + _rule(2, RULE2_COND) + ")",
    "fraud_report": _rule(1, RULE1_COND) + " UNION " + _rule(2, RULE2_COND),
    "fraud_report_bucketed": _rule(1, RULE1_COND) + " UNION " + _rule(2, RULE2_COND),
    "daily_run": _rule(1, RULE1_COND, "left_clients", "left_accounts", "left_cards")
    + " UNION "
    + _rule(2, RULE2_COND, "left_clients", "left_accounts", "left_cards"),
    "fraud_report_union": _rule(1, RULE1_COND) + " UNION " + _rule(2, RULE2_COND),
    "fraud_after_increment": f"WITH {_INCREMENT_CTES} "
    + _rule(1, RULE1_COND, "c_new", "a_new", "k_new")
    + " UNION "
    + _rule(2, RULE2_COND, "c_new", "a_new", "k_new"),
    "job_dim_clients": "SELECT * FROM job_clients",
    "job_dim_accounts": "SELECT * FROM job_accounts",
    "job_dim_cards": "SELECT * FROM job_cards",
    "job_dim_terminals": f"SELECT terminal_id, terminal_type, CASE WHEN terminal_type = 'ATM' THEN terminal_city ELSE 'first' END "
    f"terminal_city, terminal_address, CASE WHEN terminal_type = 'ATM' THEN {NTZ} '2001-01-02 00:00:00' ELSE {LOAD} END create_dt, "
    "CAST(NULL AS TIMESTAMP) update_dt FROM terminals",
    "job_fact_transactions": f"SELECT *, CASE WHEN trans_date < {NTZ} '1999-01-01 00:00:00' THEN {LOAD} "
    f"ELSE {NTZ} '2001-01-02 00:00:00' END create_dt FROM transactions",
    "job_fact_passport_blacklist": f"SELECT *, CASE WHEN entry_dt < {NTZ} '2024-01-20 00:00:00' THEN {LOAD} "
    f"ELSE {NTZ} '2001-01-02 00:00:00' END create_dt FROM blacklist",
    "job_meta_loading": "SELECT 'dwh' db_name, 'dim_clients' table_name, "
    "MAX(COALESCE(update_dt, create_dt)) last_update FROM (SELECT update_dt, create_dt FROM clients "
    "UNION ALL SELECT update_dt, create_dt FROM job_clients) UNION ALL SELECT 'dwh', 'dim_accounts', "
    "MAX(COALESCE(update_dt, create_dt)) FROM (SELECT update_dt, create_dt FROM accounts "
    "UNION ALL SELECT update_dt, create_dt FROM job_accounts) UNION ALL SELECT 'dwh', 'dim_cards', "
    "MAX(COALESCE(update_dt, create_dt)) FROM cards UNION ALL SELECT 'dwh', unnest(['dim_terminals', 'fact_transactions', "
    f"'fact_passport_blacklist']), {NTZ} '2001-01-02 00:00:00'",
    "job_rep_fraud": " UNION ALL ".join(
        "SELECT * FROM ("
        + (_rule(1, RULE1_COND, "job_clients", "job_accounts", "job_cards") + " UNION "
           + _rule(2, RULE2_COND, "job_clients", "job_accounts", "job_cards")).replace(ASOF, f"{NTZ} '{day} 00:00:00'")
        + ")"
        for day in ("2001-01-02", "2001-01-03")
    ),
}


def _needed_views(sql: str) -> list[str]:
    needed: set[str] = set()
    frontier = [sql]
    while frontier:
        text = frontier.pop()
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                frontier.append(body)
    return [name for name in VIEWS if name in needed]


def with_views(sql: str) -> str:
    """Prefix the fixture views the statement uses as CTEs."""
    names = _needed_views(sql)
    if not names:
        return sql
    ctes = ", ".join(f"{name} AS ({VIEWS[name]})" for name in names)
    stripped = sql.lstrip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {ctes}, {stripped[5:]}"
    return f"WITH {ctes} {stripped}"


def oracle_statements() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in STATEMENTS.items()}
