"""Property test: the report equals a brute-force evaluation of the reference's
two-rule UNION on random small worlds (NULLs, duplicate keys, repeated listings,
same-second transactions, unknown cards)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fraudmart.operators.report import fraud_report, fraud_report_two_pass
from fraudmart.schemas import ACCOUNTS, BLACKLIST, CARDS, CLIENTS, TRANSACTIONS

AS_OF = dt.datetime(2021, 1, 1)
IDS = ["1", "2", "3", None]
STAMPS = [None, dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1), dt.datetime(2022, 1, 1)]

clients_st = st.lists(
    st.tuples(st.sampled_from(IDS), st.sampled_from(["PA", "PB", None]), st.sampled_from(STAMPS),
              st.sampled_from(["X", None])),
    max_size=5,
)
accounts_st = st.lists(st.tuples(st.sampled_from(["A1", "A2", None]), st.sampled_from(IDS), st.sampled_from(STAMPS)),
                       max_size=5)
cards_st = st.lists(st.tuples(st.sampled_from(["K1", "K2", "K3"]), st.sampled_from(["A1", "A2", None])), max_size=5)
tx_st = st.lists(
    st.tuples(st.sampled_from(["t1", "t2", None]), st.sampled_from(["K1", "K2", "K9", None]),
              st.sampled_from([dt.datetime(2019, 5, 5, 10), dt.datetime(2019, 5, 5, 11)])),
    max_size=8,
)
bl_st = st.lists(st.sampled_from(["PA", "PB", "PZ", None]), max_size=4)


def brute_force(clients, accounts, cards, txs, listed):
    out = set()
    listed_set = {p for p in listed if p is not None}
    for cid, passport, valid_to, patronymic in clients:
        fio = "L F " + (patronymic or "")
        for acc, client, acc_valid in accounts:
            if cid is None or client != cid:
                continue
            for card, card_acc in cards:
                if acc is None or card_acc != acc:
                    continue
                for tid, tcard, when in txs:
                    if tid is None or tcard != card:
                        continue
                    expired = valid_to is not None and valid_to < AS_OF
                    if expired or (passport is not None and passport in listed_set):
                        out.add((when, passport, fio, "ph", 1, AS_OF))
                    if acc_valid is not None and acc_valid < AS_OF:
                        out.add((when, passport, fio, "ph", 2, AS_OF))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(clients_st, accounts_st, cards_st, tx_st, bl_st)
def test_report_matches_brute_force(spark, clients, accounts, cards, txs, listed):
    c = spark.createDataFrame(
        [(cid, "L", "F", pat, None, pp, vt, "ph", None, None) for cid, pp, vt, pat in clients], CLIENTS
    )
    a = spark.createDataFrame([(acc, vt, cl, None, None) for acc, cl, vt in accounts], ACCOUNTS)
    k = spark.createDataFrame([(card, acc, None, None) for card, acc in cards], CARDS)
    t = spark.createDataFrame([(tid, when, card, "P", None, "OK", "T", None) for tid, card, when in txs], TRANSACTIONS)
    b = spark.createDataFrame([(p, None, None) for p in listed], BLACKLIST)
    want = brute_force(clients, accounts, cards, txs, listed)
    for form in (fraud_report, fraud_report_two_pass):
        got = [tuple(r) for r in form(c, a, k, t, b, AS_OF).collect()]
        assert len(got) == len(set(got))  # UNION semantics: no duplicate rows
        assert set(got) == want
