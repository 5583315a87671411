"""Stream entry: each transactions file lands once as a published fact attempt."""

import datetime as dt
import os

import pytest

import fraudmart.streaming.transactions as stream
from fraudmart.plans.daily import Warehouse
from fraudmart.streaming.transactions import start_transactions_stream
from test_daily import _sources


def _write(folder, day, rows):
    with open(os.path.join(folder, f"transactions_{day:02d}012021.txt"), "w") as f:
        f.write("id;date;amount;card;type;result;terminal\n")
        for r in rows:
            f.write(";".join(r) + "\n")


def test_stream_appends_each_file_once(spark, workdir):
    root, drops = os.path.join(workdir, "wh"), os.path.join(workdir, "drops")
    os.makedirs(drops)
    wh = Warehouse(spark, root)
    wh.initial_load(_sources(spark, ["1", "2"]))
    _write(drops, 1, [("1", "2021-01-01 09:00:00", "1,5", "K1", "PAY", "OK", "T1")])
    _write(drops, 2, [("2", "2021-01-02 09:00:00", "2", "K2", "PAY", "OK", "T1"),
                      ("3", "2021-01-02 10:00:00", "3", "K2", "PAY", "OK", "T1")])
    ckpt = os.path.join(workdir, "ckpt")
    q = start_transactions_stream(spark, drops, root, ckpt)
    q.awaitTermination(120)
    assert wh.read_table("fact_transactions").count() == 3
    assert sorted(f for f in wh.store.ledger().toPandas()["name"]) == [
        "transactions_01012021.txt", "transactions_02012021.txt"]
    # restart on the same checkpoint: nothing new, nothing repeated
    start_transactions_stream(spark, drops, root, ckpt).awaitTermination(120)
    assert wh.read_table("fact_transactions").count() == 3
    assert wh.read_table("dim_clients").count() == 2  # dimensions untouched


def _run(spark, drops, root, checkpoint, stream_id="tx"):
    start_transactions_stream(spark, drops, root, checkpoint, stream_id).awaitTermination(120)


def _ids(wh):
    return sorted(r.trans_id for r in wh.read_table("fact_transactions").collect())


def _started(spark, workdir):
    wh, drops = Warehouse(spark, os.path.join(workdir, "wh")), os.path.join(workdir, "drops")
    os.makedirs(drops)
    wh.initial_load(_sources(spark, ["1", "2"]))
    return wh, drops


@pytest.mark.parametrize("clock", ["2021-06-01 12:00:00", "back"])
def test_same_second_and_clock_set_back(spark, workdir, monkeypatch, clock):
    # both files are loaded in one second, or the second one an hour "before" the first
    wh, drops = _started(spark, workdir)
    times = iter([dt.datetime(2021, 10, 31, 2, 59), *[dt.datetime(2021, 10, 31, 2, 0)] * 9])
    monkeypatch.setattr(stream, "as_of_now", lambda: str(next(times)) if clock == "back" else clock)
    _write(drops, 1, [("1", "2021-01-01 09:00:00", "1", "K1", "PAY", "OK", "T1")])
    _write(drops, 2, [("2", "2021-01-02 09:00:00", "2", "K2", "PAY", "OK", "T1")])
    _run(spark, drops, wh.store.root, os.path.join(workdir, "ckpt"))
    assert _ids(wh) == ["1", "2"]
    marks = {r.create_dt for r in wh.read_table("fact_transactions").collect()}
    assert len(marks) == 2 and max(marks) == wh.read_table("meta_loading").where("table_name = 'fact_transactions'").first().last_update


def test_ledgered_file_is_not_loaded_again(spark, workdir):
    wh, drops = _started(spark, workdir)
    _write(drops, 1, [("1", "2021-01-01 09:00:00", "1", "K1", "PAY", "OK", "T1")])
    _run(spark, drops, wh.store.root, os.path.join(workdir, "a"))
    _run(spark, drops, wh.store.root, os.path.join(workdir, "b"), "other")  # a new checkpoint
    assert _ids(wh) == ["1"]
    # the same name with other content is another file
    _write(drops, 1, [("1b", "2021-01-01 09:00:00", "10", "K1", "PAY", "OK", "T1")])
    _run(spark, drops, wh.store.root, os.path.join(workdir, "c"), "third")
    assert _ids(wh) == ["1", "1b"]


def test_too_long_value_fails_and_is_tried_again(spark, workdir):
    wh, drops = _started(spark, workdir)
    _write(drops, 1, [("1", "2021-01-01 09:00:00", "1", "K1", "PAY", "OK", "T" * 150)])
    for _ in range(2):
        with pytest.raises(Exception, match="longer than 100"):
            _run(spark, drops, wh.store.root, os.path.join(workdir, "ckpt"))
    assert _ids(wh) == [] and wh.store.ledger_files() == []
