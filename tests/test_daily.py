"""Three-day scenario of the daily job over a warehouse folder."""

import datetime as dt
import os

import pytest

from fraudmart.plans.daily import Warehouse
from fraudmart.schemas import ACCOUNTS, CARDS, CLIENTS
from xlsx_writer import write_xlsx

D = dt.datetime


def _sources(spark, clients):
    accounts = [(f"A{c}", D(2030, 1, 1) if c != "3" else D(2020, 1, 1), c, D(2020, 1, 1), None) for c in clients]
    cards = [(f"K{c}", f"A{c}", D(2020, 1, 1), None) for c in clients]
    cl = [
        (c, f"L{c}", f"F{c}", None, D(1980, 1, 1), f"P{c}", D(2020, 6, 1) if c == "1" else D(2030, 1, 1), f"+{c}",
         D(2020, 1, 1), None)
        for c in clients
    ]
    return {
        "clients": spark.createDataFrame(cl, CLIENTS),
        "accounts": spark.createDataFrame(accounts, ACCOUNTS),
        "cards": spark.createDataFrame(cards, CARDS),
    }


def _drop(folder, day, tx_rows, listed=()):
    os.makedirs(folder, exist_ok=True)
    stamp = f"{day:02d}012021"
    with open(os.path.join(folder, f"transactions_{stamp}.txt"), "w") as f:
        f.write("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n")
        for r in tx_rows:
            f.write(";".join(r) + "\n")
    write_xlsx(os.path.join(folder, f"terminals_{stamp}.xlsx"),
               [["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
                ["T1", "ATM", f"City{day}", "Addr"]])
    write_xlsx(os.path.join(folder, f"passport_blacklist_{stamp}.xlsx"),
               [["date", "passport"]] + [[D(2021, 1, day), p] for p in listed])


def test_three_days(spark, workdir):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    drops = os.path.join(workdir, "drops")
    wh.initial_load(_sources(spark, ["1", "2", "3"]))
    assert wh.read_table("dim_clients").count() == 3
    assert {r.last_update for r in wh.read_table("meta_loading").collect()} == {D(1900, 1, 1)}

    # day 1: client 1 has an expired passport, account of client 3 expired, P2 listed
    _drop(drops, 1, [("1", "2021-01-01 09:00:00", "10,50", "K1", "PAY", "OK", "T1"),
                     ("2", "2021-01-01 09:30:00", "5", "K2", "PAY", "OK", "T1"),
                     ("3", "2021-01-01 09:45:00", "7", "K3", "PAY", "OK", "T1")], listed=["P2"])
    _drop(drops, 2, [("4", "2021-01-02 09:00:00", "1", "K2", "PAY", "OK", "T1")])
    load, report = wh.daily_run(_sources(spark, ["1", "2", "3"]), drops, "2021-01-01 23:00:00")
    assert sorted(load.files) == ["passport_blacklist_01012021.xlsx", "terminals_01012021.xlsx",
                                  "transactions_01012021.txt"]
    assert wh.read_table("fact_transactions").count() == 3
    assert wh.read_table("dim_terminals").collect()[0].terminal_city == "City1"
    rep = wh.read_table("rep_fraud").collect()
    assert sorted((r.passport, r.event_type) for r in rep) == [("P1", 1), ("P2", 1), ("P3", 2)]
    assert load.watermarks["fact_transactions"] == "2021-01-01 23:00:00"
    assert load.counts["fact_transactions"] == 3 and report.counts["rep_fraud"] == 3
    assert wh.store.latest(("load",)).counts == load.counts

    # day 2 crashes after the load commit and before the report: files stay consumed
    wh.increment(_sources(spark, ["1", "2", "3"]), {}, "2021-01-02 23:00:00", files={})
    assert len(wh.read_table("rep_fraud").collect()) == 3

    # day 2 run: client 3 left the source (hard delete); next files are the day-2 ones
    load2, _ = wh.daily_run(_sources(spark, ["1", "2"]), drops, "2021-01-03 23:00:00")
    assert all("02012021" in n for n in load2.files)
    assert sorted(r.client_id for r in wh.read_table("dim_clients").collect()) == ["1", "2"]
    assert wh.read_table("fact_transactions").count() == 4
    rep2 = wh.read_table("rep_fraud")
    # two report runs; client 3's events vanish from the newer run
    assert rep2.select("report_dt").distinct().count() == 2
    newest = rep2.where("report_dt = TIMESTAMP_NTZ'2021-01-03 23:00:00'").collect()
    assert "P3" not in {r.passport for r in newest}
    assert ("P2", D(2021, 1, 2, 9)) in {(r.passport, r.event_dt) for r in newest}

    # no more files for a feed: the run fails and nothing is published
    with pytest.raises(FileNotFoundError):
        wh.daily_run(_sources(spark, ["1", "2"]), drops, "2021-01-04 23:00:00")
    assert wh.read_table("fact_transactions").count() == 4

    wh.clear_report()
    assert wh.read_table("rep_fraud").count() == 0
    wh.drop_all()
    assert wh.read_table("dim_clients").count() == 0
    assert wh.read_table("fact_transactions").count() == 0
