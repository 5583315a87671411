"""Fraud report (C20-C22): rules, dedup and plan shape."""

import datetime as dt

import pytest

from paths import SF_SMALL
from fraudmart.fixtures import AS_OF, Fixture
from fraudmart.operators.report import fraud_report, fraud_report_measured, fraud_report_two_pass, rule_contract, rule_passport
from fraudmart.schemas import ACCOUNTS, BLACKLIST, CARDS, CLIENTS, TRANSACTIONS
from plan_metrics import nodes
from plan_text import plan_text
from test_skew import conf

D = dt.datetime
AS = "2021-01-01 00:00:00"


def client(cid, valid_to, passport=None, patronymic="P"):
    return (cid, "Last", "First", patronymic, D(1980, 1, 1), passport or f"PS{cid}", valid_to, f"+{cid}",
            D(2020, 1, 1), None)


def make(spark, clients, accounts, cards, txs, blacklist=()):
    return (
        spark.createDataFrame(clients, CLIENTS),
        spark.createDataFrame(accounts, ACCOUNTS),
        spark.createDataFrame(cards, CARDS),
        spark.createDataFrame(txs, TRANSACTIONS),
        spark.createDataFrame(list(blacklist), BLACKLIST),
    )


def tx(tid, card, when):
    return (tid, when, card, "PAY", None, "OK", "T", D(2020, 1, 1))


@pytest.fixture()
def world(spark):
    clients = [
        client("1", D(2020, 1, 1)),  # passport expired
        client("2", None),  # NULL validity, not listed (H5): no rule-1 event
        client("3", None, passport="LISTED"),  # NULL validity but blacklisted
        client("4", D(2021, 1, 1)),  # valid to midnight of the report day: not expired (H6)
        client("5", D(2030, 1, 1)),  # fine
    ]
    accounts = [
        ("A1", D(2030, 1, 1), "1", D(2020, 1, 1), None),
        ("A2", D(2030, 1, 1), "2", D(2020, 1, 1), None),
        ("A3", D(2030, 1, 1), "3", D(2020, 1, 1), None),
        ("A4", D(2030, 1, 1), "4", D(2020, 1, 1), None),
        ("A5", D(2020, 6, 1), "5", D(2020, 1, 1), None),  # contract expired
    ]
    cards = [(f"K{i}", f"A{i}", D(2020, 1, 1), None) for i in range(1, 6)]
    txs = [
        tx("t1", "K1", D(2020, 5, 5, 10)),
        tx("t1b", "K1", D(2020, 5, 5, 10)),  # same second, same client: one row (H13)
        tx("t2", "K2", D(2020, 5, 5, 11)),
        tx("t3", "K3", D(2020, 5, 5, 12)),
        tx("t4", "K4", D(2020, 5, 5, 13)),
        tx("t5", "K5", D(2020, 5, 5, 14)),
        tx("tx", "UNKNOWN", D(2020, 5, 5, 15)),  # card not in the warehouse: dropped (H28)
        (None, D(2020, 5, 5, 16), "K1", "PAY", None, "OK", "T", D(2020, 1, 1)),  # trans_id NULL: dropped
    ]
    blacklist = [("LISTED", D(2019, 1, 1), D(2019, 1, 1)), ("LISTED", D(2019, 2, 1), D(2019, 2, 1))]
    return make(spark, clients, accounts, cards, txs, blacklist)


def test_rules(world):
    c, a, k, t, b = world
    r1 = {(r.passport, r.event_dt) for r in rule_passport(c, a, k, t, b, AS).collect()}
    assert r1 == {("PS1", D(2020, 5, 5, 10)), ("LISTED", D(2020, 5, 5, 12))}
    r2 = [(r.passport, r.event_type) for r in rule_contract(c, a, k, t, AS).collect()]
    assert r2 == [("PS5", 2)]


def test_report_union_dedups(world):
    c, a, k, t, b = world
    rows = fraud_report(c, a, k, t, b, AS).collect()
    assert len(rows) == 3  # H13: t1 and t1b collapse; H14: double listing does not multiply
    assert {r.event_type for r in rows} == {1, 2}
    assert all(r.report_dt == D(2021, 1, 1) for r in rows)
    fio = {r.passport: r.fio for r in rows}
    assert fio["PS1"] == "Last First P"


def test_report_time_not_transaction_time(world):
    c, a, k, t, b = world
    # H7: the same history reported a year earlier has no expired passport for client 1
    early = {r.passport for r in fraud_report(c, a, k, t, b, "2019-06-01").collect()}
    assert "PS1" not in early and "LISTED" in early


def test_both_rules_emit_two_rows(spark):
    c, a, k, t, b = make(
        spark,
        [client("1", D(2020, 1, 1))],
        [("A1", D(2020, 1, 1), "1", D(2020, 1, 1), None)],
        [("K1", "A1", D(2020, 1, 1), None)],
        [tx("t1", "K1", D(2020, 5, 5))],
    )
    assert sorted(r.event_type for r in fraud_report(c, a, k, t, b, AS).collect()) == [1, 2]


def test_single_pass_equals_two_pass_on_fixture(spark):
    fx = Fixture(spark, SF_SMALL)
    args = (fx.clients, fx.accounts, fx.cards, fx.transactions, fx.blacklist, AS_OF)
    one, two = fraud_report(*args), fraud_report_two_pass(*args)
    assert one.count() > 0
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_plan_has_no_cartesian_and_inner_chain(spark):
    fx = Fixture(spark, SF_SMALL)
    plan = plan_text(fraud_report(fx.clients, fx.accounts, fx.cards, fx.transactions, fx.blacklist, AS_OF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # the only outer join is the existence flag for the blacklist
    optimized = plan.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert optimized.count("LeftOuter") == 1
    assert optimized.count("Join Inner") == 3


@pytest.mark.parametrize("limit", [0, 1 << 28])
def test_measured_report_tells_events_apart_by_persons(spark, workdir, limit):
    """Clients with the same texts, NULLs included, are one person; those that differ in one text are not."""
    old, new = D(2020, 1, 1), D(2030, 1, 1)
    texts = [("1", "PA", "x"), ("2", "PA", "x"), ("3", "PA", "y"), ("4", None, "x"), ("5", None, "x"), ("6", "PB", None), (None, "PC", "x")]
    clients = [(cid, "L", "F", None, None, passport, old if cid != "6" else new, phone, None, None) for cid, passport, phone in texts]
    c, a, k, t, b = make(
        spark,
        clients,
        [(f"A{i}", old if i in (2, 6) else new, str(i), None, None) for i in range(1, 7)],
        [(f"K{i}", f"A{i}", None, None) for i in range(1, 7)],
        [tx(f"t{i}{n}", f"K{i}", D(2020, 5, 5, 10)) for i in range(1, 7) for n in range(2)],
        [("PB", D(2019, 1, 1), D(2019, 1, 1))],
    )
    want = sorted(map(str, fraud_report(c, a, k, t, b, AS).collect()))
    got, size = fraud_report_measured(c, a, k, t, b, AS, f"{workdir}/pin", limit)
    assert sorted(map(str, got.collect())) == want and len(want) == 6 and size > 0


def test_measured_report_moves_no_texts_with_events(spark, workdir):
    """Beyond the broadcast limit, what is shuffled for an event is numbers and flags, one row for both rules."""
    fx = Fixture(spark, SF_SMALL)
    args = (fx.clients, fx.accounts, fx.cards, fx.transactions, fx.blacklist, AS_OF)
    with conf(spark, {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        report, _ = fraud_report_measured(*args, f"{workdir}/pin", 0)
        rows = len(report.collect())
        moved = [node.output().toString() for kind, node in nodes(report) if kind == "ShuffleExchangeExec"]
    events = [columns for columns in moved if "trans_date" in columns or "event_dt" in columns]
    assert rows > 1000 and len(events) >= 2
    assert not any(text in columns for columns in events for text in ("passport_num", "fio", "phone", "event_type"))
