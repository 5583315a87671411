"""Failure between writing data and publishing it."""

import datetime as dt
import os

import pytest

from fraudmart.plans.daily import Warehouse
from fraudmart.plans.store import LOAD
from test_daily import _drop, _sources

D = dt.datetime


def test_crash_before_publish_then_rerun(spark, workdir, monkeypatch):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    drops = os.path.join(workdir, "drops")
    wh.initial_load(_sources(spark, ["1", "2", "3"]))
    _drop(drops, 1, [("1", "2021-01-01 09:00:00", "1", "K1", "PAY", "OK", "T1"),
                     ("2", "2021-01-01 09:30:00", "2", "K2", "PAY", "OK", "T1")])
    before = wh.read_table("dim_clients").count()

    real = wh.store.write_record

    def crash_on_load(rec):
        if rec.kind == LOAD:
            raise RuntimeError("executor lost during commit")
        return real(rec)

    monkeypatch.setattr(wh.store, "write_record", crash_on_load)
    with pytest.raises(RuntimeError, match="commit"):
        wh.daily_run(_sources(spark, ["1", "2"]), drops, "2021-01-01 23:00:00")
    # facts and the new dimension versions were written but never published
    assert wh.read_table("fact_transactions").count() == 0
    assert wh.read_table("dim_clients").count() == before
    assert wh.store.ledger().count() == 0
    assert {r.last_update for r in wh.read_table("meta_loading").collect()} == {D(1900, 1, 1)}

    monkeypatch.setattr(wh.store, "write_record", real)
    load, _ = wh.daily_run(_sources(spark, ["1", "2"]), drops, "2021-01-01 23:30:00")
    assert wh.read_table("fact_transactions").count() == 2  # once, not twice (H25)
    assert wh.store.ledger().count() == 3  # the three files are consumed now (H26)
    assert sorted(r.client_id for r in wh.read_table("dim_clients").collect()) == ["1", "2"]
    # Terminals take the load time as create_dt on every load
    assert wh.read_table("dim_terminals").collect()[0].create_dt == D(2021, 1, 1, 23, 30)
    assert load.watermarks["dim_terminals"] == "2021-01-01 23:30:00"


def test_rerun_without_changes_and_empty_feed(spark, workdir):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    drops = os.path.join(workdir, "drops")
    src = _sources(spark, ["1", "2"])
    wh.initial_load(src)
    _drop(drops, 1, [("1", "2021-01-01 09:00:00", "1", "K1", "PAY", "OK", "T1")], listed=["P2"])
    first, _ = wh.daily_run(src, drops, "2021-01-01 23:00:00")
    dims = {t: sorted(map(tuple, wh.read_table(t).collect())) for t in ("dim_clients", "dim_accounts", "dim_cards")}

    # a rerun of the increment over unchanged sources stages nothing and changes nothing
    again = wh.increment(src, {}, "2021-01-02 23:00:00")
    assert {t: sorted(map(tuple, wh.read_table(t).collect())) for t in dims} == dims
    assert again.watermarks == first.watermarks
    assert wh.read_table("fact_transactions").count() == 1

    # an empty feed: header-only text and an empty workbook -> no fact attempt,
    # watermarks of those facts stay
    _drop(drops, 2, [], listed=[])
    load, _ = wh.daily_run(src, drops, "2021-01-03 23:00:00")
    assert "fact_transactions" not in load.facts and "fact_passport_blacklist" not in load.facts
    assert load.watermarks["fact_transactions"] == first.watermarks["fact_transactions"]
    assert wh.read_table("fact_transactions").count() == 1
    assert wh.read_table("fact_passport_blacklist").count() == 1
    assert load.watermarks["dim_terminals"] == "2021-01-03 23:00:00"  # terminals file had a row


def test_gated_out_files_are_picked_again(spark, workdir):
    # A clock behind the watermark stages nothing from the files; they stay
    # out of the ledger and the next run loads them
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    drops = os.path.join(workdir, "drops")
    src = _sources(spark, ["1", "2"])
    wh.initial_load(src)
    _drop(drops, 1, [("1", "2021-01-01 09:00:00", "1", "K1", "PAY", "OK", "T1")])
    _drop(drops, 2, [("2", "2021-01-02 09:00:00", "1", "K2", "PAY", "OK", "T1")])
    _drop(drops, 3, [("3", "2021-01-03 09:00:00", "1", "K2", "PAY", "OK", "T1")])
    wh.daily_run(src, drops, "2021-01-01 23:00:00")
    skewed, _ = wh.daily_run(src, drops, "2021-01-01 22:00:00")  # clock went back
    # the gated feeds keep their files; the blacklist feed (empty so far, its
    # watermark still at the seed) was open and consumed its day-2 file
    assert skewed.files == ["passport_blacklist_02012021.xlsx"]
    assert wh.read_table("fact_transactions").count() == 1
    later, _ = wh.daily_run(src, drops, "2021-01-02 23:00:00")
    assert "transactions_02012021.txt" in later.files
    assert wh.read_table("fact_transactions").count() == 2


def test_second_writer_of_a_batch_fails(spark, workdir):
    root = os.path.join(workdir, "wh")
    one, two = Warehouse(spark, root), Warehouse(spark, root)
    one.initial_load(_sources(spark, ["1"]))
    rec = one.increment(_sources(spark, ["1", "2"]), {}, "2021-01-01 23:00:00")
    two.store.refresh()
    rec.attempt = "other"
    with pytest.raises(Exception, match="exists"):
        two.store.write_record(rec)
    assert one.read_table("dim_clients").count() == 2


def test_unreadable_log_is_not_an_empty_warehouse(spark, workdir):
    root = os.path.join(workdir, "wh")
    wh = Warehouse(spark, root)
    assert wh.store.next_batch_id() == 1  # no log yet
    wh.initial_load(_sources(spark, ["1"]))
    import stat

    class Broken(type(wh.store)):
        def control_path(self):
            return "nosuchscheme://x/_control"

    with pytest.raises(Exception):
        Broken(spark, root).next_batch_id()
    assert stat.S_ISDIR(os.stat(root).st_mode)


def test_initial_load_checks_widths_and_keys(spark, workdir):
    wide = _sources(spark, ["1"])
    wide["clients"] = wide["clients"].selectExpr("client_id", "repeat('x', 150) last_name", *wide["clients"].columns[2:])
    with pytest.raises(Exception, match="longer than 100"):
        Warehouse(spark, os.path.join(workdir, "a")).initial_load(wide)
    with pytest.raises(ValueError, match="duplicate"):
        Warehouse(spark, os.path.join(workdir, "b")).initial_load(_sources(spark, ["1", "1"]))


def test_idle_runs_keep_a_fixed_number_of_folders(spark, workdir):
    from fraudmart.session import checkpoint_dir

    root = os.path.join(workdir, "wh")
    wh = Warehouse(spark, root)
    src = _sources(spark, ["1", "2"])
    wh.initial_load(src)
    staging = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "fraudmart-staging")
    before = set(os.listdir(staging)) if os.path.isdir(staging) else set()
    for day in range(1, 7):
        wh.increment(src, {}, f"2021-01-0{day} 23:00:00")
        wh.build_report(f"2021-01-0{day} 23:00:00")
        assert len(os.listdir(os.path.join(root, "dims", "dim_clients"))) <= wh.store.keep_versions
    assert set(os.listdir(staging)) == before
    assert wh.read_table("dim_clients").count() == 2


def test_zoned_or_longer_stamps_are_rejected():
    from fraudmart.functions import to_stamp_text

    assert to_stamp_text("2021-03-01") == "2021-03-01 00:00:00"
    for bad in ("2021-03-01 10:00:00+05:00", "2021-03-01 10:00:00 garbage", D(2021, 1, 1, tzinfo=dt.timezone.utc)):
        with pytest.raises(ValueError):
            to_stamp_text(bad)
