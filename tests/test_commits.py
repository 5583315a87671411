"""The publish log: atomic records, conflicts, crashes, checkpoints; what is removed and what stays."""

import datetime as dt
import glob
import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from fraudmart.plans import commits
from fraudmart.plans.commits import CommitConflict, Log, put_if_absent
from fraudmart.plans.daily import Warehouse
from fraudmart.plans.store import PublishRecord
from test_daily import _drop, _sources

D = dt.datetime


def test_one_of_many_writers_wins(spark, workdir):
    for batch in range(5):
        path = os.path.join(workdir, "log", f"{batch}.json")
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda k: put_if_absent(spark, path, f"writer {k}"), range(8)))
        assert sum(won) == 1 and open(path).read() == f"writer {won.index(True)}"
    assert all(not n.startswith(".") for n in os.listdir(os.path.join(workdir, "log")))


def test_non_local_file_system(spark, workdir, monkeypatch):
    """The same on the path that HDFS takes: a hidden file, then a rename that must not replace."""
    from fraudmart.session import file_system

    class Remote:
        def __init__(self, fs):
            self.fs = fs

        def getScheme(self):
            return "hdfs"

        def __getattr__(self, name):
            return getattr(self.fs, name)

    def remote(session, path):
        fs, target = file_system(session, path)
        return Remote(fs), target

    monkeypatch.setattr(commits, "file_system", remote)
    path = os.path.join(workdir, "x.json")
    assert put_if_absent(spark, path, "one\n") and not put_if_absent(spark, path, "two\n")
    assert open(path).read() == "one\n" and not [n for n in os.listdir(workdir) if n.startswith(".x.json-")]


def test_a_thousand_records_are_one_file(spark, workdir):
    log = Log(spark, os.path.join(workdir, "_control"), fold_every=1000)
    for batch in range(1, 1001):
        log.append({"batch_id": batch, "kind": "load"})
    assert [r["batch_id"] for r in log.read()] == list(range(1, 1001)) and log.opened == 1
    log.append({"batch_id": 1001, "kind": "load"})
    assert len(log.read()) == 1001 and log.opened == 2
    with pytest.raises(CommitConflict):
        log.append({"batch_id": 7, "kind": "late"})  # a folded batch id stays taken
    # a checkpoint only repeats the records: without it the log reads the same
    for name in glob.glob(os.path.join(workdir, "_control", "checkpoint-*")):
        os.remove(name)
    assert [r["batch_id"] for r in log.read()] == list(range(1, 1002))


def test_checkpoint_keeps_the_state(spark, workdir):
    folded = Warehouse(spark, os.path.join(workdir, "a"))
    folded.store.fold_every = 2
    plain = Warehouse(spark, os.path.join(workdir, "b"))
    src = _sources(spark, ["1", "2"])
    for wh in (folded, plain):
        wh.initial_load(src)
        for day in range(1, 6):
            wh.increment(src, {}, f"2021-01-0{day} 23:00:00")
    assert glob.glob(os.path.join(workdir, "a", "_control", "checkpoint-*"))
    for table in ("dim_clients", "dim_cards", "meta_loading"):
        assert sorted(map(tuple, folded.read_table(table).collect())) == sorted(map(tuple, plain.read_table(table).collect()))
    assert folded.store.next_batch_id() == plain.store.next_batch_id() == 7


@pytest.mark.parametrize("point", ["before", "hidden", "after", "checkpoint"])
def test_crash_at_any_point_of_a_commit(spark, workdir, monkeypatch, point):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    wh.store.fold_every = 2  # the second record is followed by a checkpoint
    drops = os.path.join(workdir, "drops")
    src = _sources(spark, ["1", "2"])
    wh.initial_load(src)
    _drop(drops, 1, [("1", "2021-01-01 09:00:00", "1", "K1", "PAY", "OK", "T1")])
    real = commits.put_if_absent

    def crashing(session, path, text):
        if point == "before":
            raise KeyboardInterrupt("killed")
        if point == "hidden":
            with open(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}-left"), "w") as out:
                out.write(text[: len(text) // 2])
            raise KeyboardInterrupt("killed")
        done = real(session, path, text)
        if point == "after" or commits.CHECKPOINT in path:
            raise KeyboardInterrupt("killed")
        return done

    monkeypatch.setattr(commits, "put_if_absent", crashing)
    with pytest.raises(KeyboardInterrupt):
        wh.daily_run(src, drops, "2021-01-01 23:00:00")
    monkeypatch.setattr(commits, "put_if_absent", real)
    # folders of another layout or half-made jobs don't disturb either
    os.makedirs(os.path.join(workdir, "wh", "_control", "000000000009", "_temporary"))
    again = Warehouse(spark, os.path.join(workdir, "wh"))
    if point in ("before", "hidden"):
        assert again.read_table("fact_transactions").count() == 0
        again.daily_run(src, drops, "2021-01-01 23:30:00")
    assert again.read_table("fact_transactions").count() == 1
    assert again.store.ledger().count() == 3
    again.build_report("2021-01-02 00:00:00")
    assert again.read_table("dim_clients").count() == 2


def test_stream_loads_do_not_keep_old_versions_alive(spark, workdir):
    """Days with many loads between them that change no dimension: old versions still go."""
    root = os.path.join(workdir, "wh")
    wh = Warehouse(spark, root)
    wh.store.fold_every = 1000
    wh.initial_load(_sources(spark, ["1"]))
    for day in range(1, 5):
        stamp = F.lit(f"2021-01-0{day} 12:00:00").cast("timestamp_ntz")
        src = {name: df.withColumn("create_dt", stamp) for name, df in _sources(spark, ["1", str(day + 1)]).items()}
        wh.increment(src, {}, f"2021-01-0{day} 23:00:00")
        for k in range(8):
            wh.store.refresh()
            state = wh.store.state()
            state.batch_id, state.attempt = wh.store.next_batch_id(), f"s{day}{k}"
            wh.store.write_record(state)
            wh.store.prune()
    states = []
    for rec in wh.store.committed(("load",)):
        if rec.parts["dim_clients"] not in states:
            states.append(rec.parts["dim_clients"])
    assert len(states) == 5  # of which the newest three stay
    on_disk = {os.path.basename(p)[2:] for p in glob.glob(os.path.join(root, "dims", "dim_clients", "v=*"))}
    assert on_disk == {v for state in states[-3:] for v in state.values()}
    assert sorted(r.client_id for r in wh.read_table("dim_clients").collect()) == ["1", "5"]


def test_only_changed_parts_are_rewritten(spark, workdir):
    """Files of untouched parts stay, the dimension is what a full rewrite gives."""
    root = os.path.join(workdir, "wh")
    wh = Warehouse(spark, root)
    clients = [str(k) for k in range(1, 41)]
    wh.initial_load(_sources(spark, clients))
    wh.increment(_sources(spark, clients), {}, "2021-01-01 23:00:00")  # recaptures everything (H23)
    before = {p: os.stat(p).st_mtime_ns for p in glob.glob(os.path.join(root, "dims", "dim_clients", "*", "*", "*.parquet"))}
    old = wh.store.state().parts["dim_clients"]

    src = _sources(spark, clients[:-1] + ["77"])  # client 40 leaves, 77 comes
    changed = src["clients"].selectExpr(
        *(f"CASE WHEN client_id = '77' THEN timestamp_ntz'2021-06-01 00:00:00' ELSE create_dt END AS {c}" if c == "create_dt" else c for c in src["clients"].columns)
    )
    rec = wh.increment({**src, "clients": changed}, {}, "2021-06-02 23:00:00")
    new = rec.parts["dim_clients"]
    moved = {p for p in new if new[p] != old.get(p)} | (set(old) - set(new))
    assert 1 <= len(moved) <= 2 and len(new) > 10
    after = {p: os.stat(p).st_mtime_ns for p in before if os.path.exists(p)}
    assert after == before  # the last state but one is kept, too
    assert sorted(r.client_id for r in wh.read_table("dim_clients").collect()) == sorted(clients[:-1] + ["77"])
    idle = wh.increment({**src, "clients": changed}, {}, "2021-06-03 23:00:00")
    assert idle.parts == rec.parts and idle.versions == rec.versions  # nothing changed: nothing written


def test_vacuum_removes_by_age_and_spares_the_living(spark, workdir):
    root = os.path.join(workdir, "wh")
    wh = Warehouse(spark, root)
    drops = os.path.join(workdir, "drops")
    src = _sources(spark, ["1", "2", "3"])
    wh.initial_load(src)
    _drop(drops, 1, [("1", "2021-01-01 09:00:00", "1", "K1", "PAY", "OK", "T1")], listed=["P2"])
    wh.daily_run(src, drops, "2021-01-01 23:00:00")
    wh.clear_report()
    orphan = os.path.join(root, "facts", "fact_transactions", "batch_id=2", "attempt=acrashed")
    working = os.path.join(root, "facts", "fact_transactions", "batch_id=99", "attempt=aworking")
    for folder in (orphan, working):
        os.makedirs(folder)
    assert wh.vacuum(retain_hours=1) == []  # all too young
    removed = wh.vacuum(retain_hours=0)
    assert any("acrashed" in p for p in removed) and any("rep_fraud" in p for p in removed)
    assert not os.path.exists(orphan) and os.path.exists(working)
    assert wh.read_table("fact_transactions").count() == 1 and wh.read_table("dim_clients").count() == 3

    wh.drop_all()
    assert wh.read_table("fact_transactions").count() == 0
    wh.initial_load(src)  # a table with the same name
    assert wh.vacuum(retain_hours=1) == []
    wh.vacuum(retain_hours=0)
    left = [p for p in glob.glob(os.path.join(root, "facts", "*", "*", "*", "*.parquet"))]
    assert left == [] and wh.read_table("dim_clients").count() == 3


def test_a_day_of_reports_is_one_partition(spark, workdir):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    drops = os.path.join(workdir, "drops")
    src = _sources(spark, ["1", "2", "3"])
    wh.initial_load(src)
    _drop(drops, 1, [("1", "2021-01-01 09:00:00", "1", "K1", "PAY", "OK", "T1"), ("2", "2021-01-01 09:00:00", "1", "K3", "PAY", "OK", "T1")])
    wh.daily_run(src, drops, "2021-01-01 23:00:00")
    wh.build_report("2021-01-02 09:00:00")
    wh.build_report("2021-01-02 10:00:00")
    assert wh.read_table("rep_fraud").count() == 6
    day = wh.read_report("2021-01-02")
    assert {r.report_dt for r in day.collect()} == {D(2021, 1, 2, 9), D(2021, 1, 2, 10)} and day.count() == 4
    assert all("report_date=2021-01-02" in f for f in day.inputFiles())
    assert wh.read_report("2020-01-01").count() == 0
    by_client = wh.read_table("rep_fraud").where("passport = 'P1'")
    assert "EqualTo(passport,P1)" in by_client._jdf.queryExecution().toString() and by_client.count() == 3
    files = glob.glob(os.path.join(workdir, "wh", "report", "rep_fraud", "report_date=2021-01-02", "*", "*", "*.parquet"))
    reader = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for file in files:
        meta = reader.readFooter(conf, spark._jvm.org.apache.hadoop.fs.Path(file))
        for block in meta.getBlocks():
            held = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in block.getColumns()}
            assert held["passport"] >= 0 and held["phone"] < 0


def test_a_failed_job_cancels_the_others(spark, workdir):
    import time

    wh = Warehouse(spark, os.path.join(workdir, "wh"))

    def endless():
        started = time.time()
        while time.time() - started < 60:
            spark.range(0, 200, 1, 200).selectExpr("sum(hash(id))").collect()
        return "ran on"

    def failing():
        time.sleep(1)
        spark.range(1).selectExpr("raise_error('no pin')").collect()

    begun = time.time()
    with pytest.raises(Exception, match="no pin"):
        wh._all({"a": endless, "b": failing, "c": endless, "d": endless})
    assert time.time() - begun < 30


def test_record_round_trip(spark, workdir):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    rec = PublishRecord(1, "load", "a1", "2021-01-01 00:00:00", {"d": "v"}, {"d": {"0": "v"}}, 16, {"t": "w"}, {"f": "a"}, ["ü"], [("ü", 1, 2)], {"f": 3})
    wh.store.write_record(rec)
    assert wh.store.records() == [rec]
    name = os.path.join(workdir, "wh", "_control", "000000000001.json")
    assert json.loads(open(name).read())["files"] == ["ü"]
