"""Fraud report.

Two rules over the chain client -> account -> card -> transaction:

1. the client's passport expired before the report time, or is blacklisted;
2. the account contract expired before the report time.

Both compare with the *report* time, not the transaction's own time (H7), with a
strict ``<`` on timestamps (H6).  The output is the UNION of both rules, which
also removes duplicates inside one rule (H13).

The reference joins with LEFT JOINs but filters ``trans_id IS NOT NULL``, which
makes every join inner (H12); inner joins are written here, so Catalyst never
keeps an outer join it could not prove redundant.

Plan shape (single pass, the default): each rule's predicate depends on one
dimension only, so it is evaluated on the dimension side, the chain
clients ⋈ accounts ⋈ cards is reduced to the *relevant* cards before it meets the
transactions, and the largest table is scanned and shuffled once instead of once
per rule.  Every join is an equi-join on the business key; AQE picks broadcast
only when a side's runtime size is under ``autoBroadcastJoinThreshold`` and splits
skewed key partitions (a hot card or corporate client) otherwise.
"""

from __future__ import annotations

import datetime as _dt
import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.functions import as_ntz, check_max_length, full_name
from fraudmart.operators.broadcast import pinned_broadcast
from fraudmart.schemas import EVENT_CONTRACT, EVENT_PASSPORT, VARCHAR_LIMIT

Stamp = str | _dt.datetime | _dt.date | Column

# In-memory size up to which the flagged cards are broadcast.
BROADCAST_LIMIT = 256 * 1024 * 1024

# Bits of a bitmap of Spark's bitmap functions, and bits for each flagged card.
BITMAP_BITS = 32768
BITS_A_CARD = 8
# Flagged cards, in memory, from which on a bitmap of them is worth its broadcast.
BITMAP_LEAST = 32 * 1024 * 1024

REPORT_COLUMNS = ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
# What a report row tells of its client.
PERSON = ["passport_num", "phone", "fio"]


def listed_passports(blacklist: DataFrame) -> DataFrame:
    """Distinct blacklisted passports: an existence test never multiplies rows.

    The distinct is a partial (map-side) aggregate, so a passport listed many
    times collapses before the shuffle.
    """
    return blacklist.select(F.col("passport_num").alias("_listed_passport")).where(
        F.col("_listed_passport").isNotNull()
    ).distinct()


def with_listed_flag(clients: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Add ``listed``: whether ``passport_num IN (SELECT passport_num FROM blacklist)``.

    A left join to the distinct keys is Spark's existence join; NULL passports are
    never listed.  Each NULL gets a key of its own (a character that no passport
    begins with, then the client), so NULLs don't meet in one partition.
    """
    keys = listed_passports(blacklist)
    own_key = F.coalesce(F.col("passport_num"), F.concat(F.lit("\u0000"), F.coalesce("client_id", F.lit(""))))
    return (
        clients.join(keys, own_key == keys["_listed_passport"], "left")
        .withColumn("listed", F.col("_listed_passport").isNotNull())
        .drop("_listed_passport")
    )


def _client_side(clients: DataFrame) -> DataFrame:
    return clients.select(
        "client_id",
        "passport_num",
        "passport_valid_to",
        F.col("phone"),
        full_name("last_name", "first_name", "patronymic").alias("fio"),
    )


def _emit(chain: DataFrame, event_type: Column, as_of: Stamp) -> DataFrame:
    out = chain.select(
        F.col("trans_date").alias("event_dt"),
        F.col("passport_num").alias("passport"),
        check_max_length("fio", VARCHAR_LIMIT, "fio").alias("fio"),
        F.col("phone"),
        event_type.alias("event_type"),
    ).distinct()
    return out.withColumn("report_dt", as_ntz(as_of)).select(*REPORT_COLUMNS)


def _live_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("trans_id").isNotNull()).select("card_num", "trans_date")


def _chain(client_side: DataFrame, accounts: DataFrame, cards: DataFrame, transactions: DataFrame) -> DataFrame:
    """client ⋈ account ⋈ card ⋈ transaction, inner, smallest sides first."""
    acc = accounts.select("account_num", F.col("client").alias("client_id"), "valid_to")
    ca = client_side.join(acc, "client_id")
    kc = cards.select("card_num", "account_num").join(ca, "account_num")
    return _live_transactions(transactions).join(kc, "card_num")


def rule_passport(
    clients: DataFrame,
    accounts: DataFrame,
    cards: DataFrame,
    transactions: DataFrame,
    blacklist: DataFrame,
    as_of: Stamp,
) -> DataFrame:
    """Rule 1 (C20): passport expired or blacklisted.

    A NULL ``passport_valid_to`` is never expired but may be listed (H5).
    """
    cl = with_listed_flag(_client_side(clients), blacklist)
    cl = cl.where((F.col("passport_valid_to") < as_ntz(as_of)) | F.col("listed"))
    return _emit(_chain(cl, accounts, cards, transactions), F.lit(EVENT_PASSPORT), as_of)


def rule_contract(
    clients: DataFrame,
    accounts: DataFrame,
    cards: DataFrame,
    transactions: DataFrame,
    as_of: Stamp,
) -> DataFrame:
    """Rule 2 (C21): the account contract expired."""
    acc = accounts.where(F.col("valid_to") < as_ntz(as_of))
    return _emit(_chain(_client_side(clients), acc, cards, transactions), F.lit(EVENT_CONTRACT), as_of)


def fraud_report_two_pass(
    clients: DataFrame,
    accounts: DataFrame,
    cards: DataFrame,
    transactions: DataFrame,
    blacklist: DataFrame,
    as_of: Stamp,
) -> DataFrame:
    """The literal shape: rule 1 UNION rule 2 (each branch scans the chain)."""
    r1 = rule_passport(clients, accounts, cards, transactions, blacklist, as_of)
    r2 = rule_contract(clients, accounts, cards, transactions, as_of)
    return r1.unionByName(r2).distinct()


def relevant_cards(
    clients: DataFrame,
    accounts: DataFrame,
    cards: DataFrame,
    blacklist: DataFrame,
    as_of: Stamp,
) -> DataFrame:
    """Cards that can fire a rule, with the client attributes and rule flags.

    Each rule depends on one dimension, so the flags are computed on the
    dimension rows and only cards with a flag set survive.  With unique
    dimension keys there is at most one row per card.
    """
    ts = as_ntz(as_of)
    return _cards_that_fire(_flagged_clients(clients, blacklist, ts), accounts, cards, ts, PERSON)


def _flagged_clients(clients: DataFrame, blacklist: DataFrame, ts: Column) -> DataFrame:
    """Clients with the flag of rule 1."""
    return with_listed_flag(_client_side(clients), blacklist).select(
        "client_id",
        *PERSON,
        F.coalesce((F.col("passport_valid_to") < ts) | F.col("listed"), F.lit(False)).alias("r_passport"),
    )


def _cards_that_fire(clients: DataFrame, accounts: DataFrame, cards: DataFrame, ts: Column, carried: list[str]) -> DataFrame:
    """Cards of flagged clients or accounts, with the columns ``carried`` of the client and both flags."""
    return cards.select("card_num", "account_num").join(_accounts_that_fire(clients, accounts, ts, carried), "account_num").select(
        "card_num", *carried, "r_passport", "r_contract"
    )


def _accounts_that_fire(clients: DataFrame, accounts: DataFrame, ts: Column, carried: list[str]) -> DataFrame:
    acc = accounts.select(
        "account_num",
        F.col("client").alias("client_id"),
        F.coalesce(F.col("valid_to") < ts, F.lit(False)).alias("r_contract"),
    )
    relevant = clients.join(acc, "client_id").where(F.col("r_passport") | F.col("r_contract"))
    return relevant.select("account_num", *carried, "r_passport", "r_contract")


def pinned_cards(
    clients: DataFrame,
    accounts: DataFrame,
    cards: DataFrame,
    blacklist: DataFrame,
    as_of: Stamp,
    pin_path: str,
    broadcast_limit_bytes: int,
) -> tuple[DataFrame, DataFrame, int]:
    """Cards that can fire a rule with ``fired``, those texts by ``person``, and the bytes of the cards.

    ``fired`` is four times the number of the client's texts plus the rules that fire (1 and 2, see :func:`_rules`): one
    number, so that cards and events are as narrow as they can be where they are shuffled.

    Equal (passport, phone, name) have one number, so events are told apart by numbers and the texts
    join them at the end.  All three frames are pinned at ``pin_path``, which also fixes the numbers, and
    broadcast where they are measured to fit.
    """
    ts = as_ntz(as_of)
    named = _client_side(clients).where(F.col("client_id").isNotNull()).select(*PERSON).distinct()
    numbered = named.withColumn("person", F.monotonically_increasing_id())
    persons, _ = pinned_broadcast(numbered, f"{pin_path}-persons", broadcast_limit_bytes)
    texts = persons.withColumnsRenamed({c: f"_{c}" for c in PERSON})
    same = functools.reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PERSON))
    known = _flagged_clients(clients, blacklist, ts).where(F.col("client_id").isNotNull())
    known = known.join(texts, same).select("client_id", "person", "r_passport")
    people, _ = pinned_broadcast(known, f"{pin_path}-people", broadcast_limit_bytes)
    accounts = _accounts_that_fire(people, accounts, ts, ["person"]).select("account_num", (F.col("person") * 4 + _rules()).alias("fired"))
    flagged = cards.select("card_num", "account_num").join(accounts, "account_num").select("card_num", "fired")
    flagged, size = pinned_broadcast(flagged, pin_path, broadcast_limit_bytes)
    return flagged, persons, size


def events_for_cards(transactions: DataFrame, cards_flagged: DataFrame, as_of: Stamp) -> DataFrame:
    """Match transactions to flagged cards and emit one row per rule that fires
    (``explode`` of at most two types), then one distinct."""
    return events_for_parts([(transactions, cards_flagged)], as_of)


def events_for_parts(parts: list[tuple[DataFrame, DataFrame]], as_of: Stamp) -> DataFrame:
    """The same for parts of the fact that are matched in different ways: (transactions, flagged cards) each."""
    joined = [_live_transactions(transactions).join(cards, "card_num").drop("card_num") for transactions, cards in parts]
    matched = functools.reduce(DataFrame.unionByName, joined)
    return _emit(matched, F.explode(_event_types()), as_of)


def _rules() -> Column:
    """Both flags as a number: 1 for the passport, 2 for the contract."""
    return F.when(F.col("r_passport"), F.lit(1)).otherwise(F.lit(0)) + F.when(F.col("r_contract"), F.lit(2)).otherwise(F.lit(0))


def _event_types() -> Column:
    return F.array_compact(
        F.array(
            F.when(F.col("r_passport"), F.lit(EVENT_PASSPORT)),
            F.when(F.col("r_contract"), F.lit(EVENT_CONTRACT)),
        )
    )


def events_of_persons(parts: list[tuple[DataFrame, DataFrame]], persons: DataFrame, as_of: Stamp) -> DataFrame:
    """:func:`events_for_parts` for cards and persons of :func:`pinned_cards`.

    One row a person and time is aggregated, a number, a time and the rules that fire, before
    the texts join it and the rules become rows of their own.
    """
    joined = [_live_transactions(transactions).join(cards, "card_num").drop("card_num") for transactions, cards in parts]
    person, rules = F.shiftright("fired", 2).alias("person"), F.col("fired").bitwiseAND(3).cast("byte").alias("rules")
    fired = functools.reduce(DataFrame.unionByName, joined).select(person, "trans_date", rules).groupBy("person", "trans_date")
    once = fired.agg(F.bit_or("rules").alias("rules"))
    once = once.select("person", "trans_date", *((F.col("rules").bitwiseAND(n) > 0).alias(c) for c, n in (("r_passport", 1), ("r_contract", 2))))
    return once.join(persons, "person").select(
        F.col("trans_date").alias("event_dt"),
        F.col("passport_num").alias("passport"),
        check_max_length("fio", VARCHAR_LIMIT, "fio").alias("fio"),
        F.col("phone"),
        F.explode(_event_types()).alias("event_type"),
        as_ntz(as_of).alias("report_dt"),
    )


def fraud_report(
    clients: DataFrame,
    accounts: DataFrame,
    cards: DataFrame,
    transactions: DataFrame,
    blacklist: DataFrame,
    as_of: Stamp,
) -> DataFrame:
    """The report (C22) in one pass over the join chain: only cards that can fire
    a rule meet the transactions, and the fact is scanned once for both rules."""
    return events_for_cards(transactions, relevant_cards(clients, accounts, cards, blacklist, as_of), as_of)


def fraud_report_measured(
    clients: DataFrame,
    accounts: DataFrame,
    cards: DataFrame,
    transactions: DataFrame,
    blacklist: DataFrame,
    as_of: Stamp,
    pin_path: str,
    broadcast_limit_bytes: int = BROADCAST_LIMIT,
) -> tuple[DataFrame, int]:
    """The report, and the measured bytes of the flagged cards.

    The flagged cards are written to ``pin_path`` once and measured.  Up to the limit
    they are broadcast, so the transactions are never shuffled; beyond it the plan is
    the shuffle join behind a bitmap of the cards (:func:`of_known_cards`) and, for the largest facts, a
    runtime Bloom filter; it needs no shuffle of history if the fact is bucketed by card (see :mod:`fraudmart.plans.catalog`).
    """
    pinned, persons, size = pinned_cards(clients, accounts, cards, blacklist, as_of, pin_path, broadcast_limit_bytes)
    if size > broadcast_limit_bytes:
        if size > BITMAP_LEAST:
            transactions = of_known_cards(transactions, pinned)
        pinned = with_runtime_filter(pinned)
    return events_of_persons([(transactions, pinned)], persons, as_of), size


def of_known_cards(transactions: DataFrame, cards_flagged: DataFrame) -> DataFrame:
    """Transactions without most of those whose card isn't flagged, before they are shuffled to the cards.

    Eight bits a card, one of them set by its hash: about one in eight of the other cards' rows is left, no row of a
    flagged card is lost, and the join that follows is exact.  The bitmaps (4 KB each) are built by the
    tasks that read the pinned cards and take a byte a card in the broadcast, a sixtieth of what the cards would.
    """
    buckets = max(1, -(-cards_flagged.count() * BITS_A_CARD // BITMAP_BITS))  # from the footers of the pinned files
    place = F.pmod(F.xxhash64("card_num"), F.lit(buckets * BITMAP_BITS))
    bucket, bit = F.shiftright(place, 15), F.pmod(place, F.lit(BITMAP_BITS))
    bitmaps = cards_flagged.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    placed = transactions.withColumns({"_place": bucket, "_bit": bit}).join(F.broadcast(bitmaps), F.col("_place") == F.col("_bucket"))
    byte = F.ascii(F.decode(F.substring("_bits", F.shiftright("_bit", 3).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    known = F.getbit(byte, F.pmod("_bit", F.lit(8)).cast("int")) == 1
    return placed.where(known).select(*transactions.columns)


def with_runtime_filter(cards_flagged: DataFrame) -> DataFrame:
    """Flagged cards too large to broadcast, as a side that Spark makes a runtime Bloom filter of.

    The planner does so only for a side with a comparison over its scan; this one is true for
    every card number, so nothing is lost.  Transactions of other cards are then mostly dropped
    where they are scanned, before the shuffle.
    """
    return cards_flagged.where(F.col("card_num") >= F.lit(""))
