"""What isn't read or moved: folders by watermark, rows by a runtime Bloom filter, consumed drops."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.fixtures import AS_OF, WATERMARK, Fixture
from fraudmart.operators.capture import capture_changed, capture_clients
from fraudmart.operators.report import fraud_report_measured, of_known_cards
from fraudmart.operators.scd1 import key_counts, key_marks, missing_keys, scd1_apply, scd1_apply_marked, scd1_apply_vanished, vanished_keys
from fraudmart.operators.watermarks import seed_watermarks, watermark_column
from fraudmart.plans.daily import Warehouse
from fraudmart.queries import QUERIES, q_capture_by_day
from fraudmart.sources.layout import write_by_change_date
from fraudmart.sources.tables import read_source
from fraudmart.sources.text import read_feed_text
from fraudmart.sources.xlsx import BLACKLIST_FILE_SCHEMA
from fraudmart.streaming.transactions import archive_consumed, start_transactions_stream
from paths import SF_SMALL
from plan_metrics import metric, nodes
from test_daily import _drop, _sources
from test_skew import conf

D = dt.datetime


def test_capture_reads_only_days_after_the_watermark(spark, workdir):
    path = os.path.join(workdir, "clients")
    clients = Fixture(spark, SF_SMALL).clients
    write_by_change_date(clients, path)
    days = len([n for n in os.listdir(path) if n.startswith("change_date=")])
    control = seed_watermarks(spark, tables=("dim_clients",), stamp="1997-04-01 00:00:00")
    want = sorted(map(str, capture_clients(clients, "1997-04-01 00:00:00").collect()))
    for mark in (watermark_column(control, "dim_clients"), "1997-04-01 00:00:00"):
        got = capture_clients(read_source(spark, "clients", path), mark)
        assert "PartitionFilters: [isnotnull(change_date" in got._jdf.queryExecution().toString()
        assert sorted(map(str, got.collect())) == want
        read = metric(got, "FileSourceScanExec", "numPartitions")
        assert len(read) == 1 and 0 < read[0] < days / 2, (read, days)
    # without a watermark row nothing is captured, and nothing read
    none = capture_clients(read_source(spark, "clients", path), watermark_column(control, "dim_cards"))
    assert none.collect() == [] and sum(metric(none, "FileSourceScanExec", "numFiles")) == 0


def test_rows_of_the_watermarks_day_and_without_stamp(spark, workdir):
    """The folder of the watermark's own day is read: a later time of that day is new."""
    rows = [("a", D(2021, 1, 1, 8), None), ("b", D(2021, 1, 1, 10), None), ("c", None, None), ("d", D(2020, 1, 1), D(2021, 1, 2))]
    df = spark.createDataFrame(rows, "id string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    path = os.path.join(workdir, "x")
    write_by_change_date(df, path)
    got = capture_changed(spark.read.parquet(path), "2021-01-01 09:00:00").collect()
    assert sorted(r.id for r in got) == ["b", "d"]


def test_capture_by_day_query(spark):
    got = q_capture_by_day(spark, SF_SMALL)
    assert got.count() == QUERIES["capture_clients"](spark, SF_SMALL).count()
    assert WATERMARK and "change_date" not in got.columns


def test_bloom_filter_before_the_fact_is_shuffled(spark, workdir):
    """Flagged cards beyond the broadcast limit: other cards' transactions go before the shuffle."""
    fx = Fixture(spark, SF_SMALL)
    # few clients can fire a rule
    clients = fx.clients.where("CAST(client_id AS BIGINT) % 10 = 1")
    tables = (clients, fx.accounts, fx.cards, fx.transactions, fx.blacklist)
    moved, rows = {}, {}
    for on in ("false", "true"):
        settings = {
            "spark.sql.optimizer.runtime.bloomFilter.enabled": on,
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
            "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "100000",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        }
        with conf(spark, settings):
            report, size = fraud_report_measured(*tables, AS_OF, os.path.join(workdir, f"pin-{on}"), broadcast_limit_bytes=0)
            rows[on] = sorted(map(str, report.collect()))
            assert size > 0
            assert ("might_contain" in report._jdf.queryExecution().executedPlan().toString()) == (on == "true")
            moved[on] = sum(metric(report, "ShuffleExchangeExec", "shuffleRecordsWritten"))
    assert rows["true"] == rows["false"] and len(rows["true"]) > 50
    assert moved["true"] < moved["false"] / 2, moved


def test_null_target_keys_go_around_the_join(spark):
    target = spark.createDataFrame([("1",), ("2",), (None,), (None,)], "client_id string")
    keys = spark.createDataFrame([("2",), (None,), ("9",)], "id string")
    got = missing_keys(target, keys, "client_id")
    assert sorted(r.client_id or "" for r in got.collect()) == ["", "", "1"]
    assert "isnull(client_id" in got._jdf.queryExecution().toString() and "Union" in got._jdf.queryExecution().toString()


def test_apply_by_vanished_keys_is_apply(spark):
    schema = "k string, v int"
    target = spark.createDataFrame([("1", 1), ("2", 2), ("2", 20), ("3", 3), (None, 4), (None, 5)], schema)
    staged = spark.createDataFrame([("2", 22), ("5", 55), ("6", 66), (None, 7)], schema)
    keys = spark.createDataFrame([("2",), ("2",), ("5",), (None,)], "id string")
    vanished = vanished_keys(target, staged, keys, "k")
    assert sorted(r.k for r in vanished.collect()) == ["1", "3", "6"]
    vanished = spark.createDataFrame(vanished.collect(), "k string")  # as the job does, pinned
    want = sorted(map(str, scd1_apply(target, staged, keys, "k").collect()))
    for small in (False, True):
        got = scd1_apply_vanished(target, staged, vanished, "k", small)
        assert sorted(map(str, got.collect())) == want
        moved = [k for k, _ in nodes(got) if k == "ShuffleExchangeExec"]
        assert len(moved) <= 1 if small else len(moved) >= 2  # small: only staged keys that the target has


def test_batch_archive(spark, workdir):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    drops, archive = os.path.join(workdir, "drops"), os.path.join(workdir, "archive")
    src = _sources(spark, ["1", "2"])
    wh.initial_load(src)
    _drop(drops, 1, [("1", "2021-01-01 09:00:00", "1", "K1", "PAY", "OK", "T1")])
    _drop(drops, 2, [("2", "2021-01-02 09:00:00", "1", "K1", "PAY", "OK", "T1")])
    first = set(n for n in os.listdir(drops) if "_01012021" in n)
    wh.daily_run(src, drops, "2021-01-01 23:00:00", archive=archive)
    assert set(os.listdir(archive)) - {n for n in os.listdir(archive) if n.startswith(".")} == first
    assert not first & set(os.listdir(drops)) and len(first) == 3
    # the same names again with other content: new files, and none in the archive is replaced
    _drop(drops, 1, [("3", "2021-01-01 09:00:00", "7", "K2", "PAY", "OK", "T1")])
    wh.daily_run(src, drops, "2021-01-02 23:00:00", archive=archive)
    assert len([n for n in os.listdir(archive) if n.startswith("transactions_01012021")]) == 2
    assert wh.read_table("fact_transactions").count() == 2


def test_stream_archive(spark, workdir):
    """The file source archives what it consumed; the last file is moved when the stream has ended."""
    root, drops, archive = (os.path.join(workdir, n) for n in ("wh", "feed", "archive"))
    wh = Warehouse(spark, root)
    wh.initial_load(_sources(spark, ["1"]))
    for day in range(1, 5):
        _drop(drops, day, [(str(day), f"2021-01-0{day} 09:00:00", "1", "K1", "PAY", "OK", "T1")])
    checkpoint = os.path.join(workdir, "checkpoint")
    for _ in range(2):
        start_transactions_stream(spark, drops, root, checkpoint, archive=archive).awaitTermination(180)
    assert wh.read_table("fact_transactions").count() == 4
    moved = archive_consumed(spark, drops, root, archive)
    inside = archive + os.path.realpath(drops)
    names = {f"transactions_0{day}012021.txt" for day in range(1, 5)}
    assert {n for n in os.listdir(inside) if not n.startswith(".")} == names and 1 <= len(moved) < 4
    assert not [n for n in os.listdir(drops) if n.startswith("transactions")]  # other feeds stay
    assert len([n for n in os.listdir(drops) if n.endswith(".xlsx")]) == 8
    assert {r.name for r in wh.store.ledger().collect()} == names
    assert archive_consumed(spark, drops, root, archive) == []
    start_transactions_stream(spark, drops, root, checkpoint, archive=archive).awaitTermination(180)
    assert wh.read_table("fact_transactions").count() == 4


def test_text_feed(spark, workdir):
    path = os.path.join(workdir, f"passport_blacklist_{uuid.uuid4().hex}.txt")
    with open(path, "w") as out:
        out.write("day;who\n2021-01-05 00:00:00;P1\n2021-01-06 10:00:00; \n")
    got = read_feed_text(spark, path, BLACKLIST_FILE_SCHEMA).orderBy(F.col(BLACKLIST_FILE_SCHEMA.names[0]))
    assert got.dtypes == [(f.name, f.dataType.simpleString()) for f in BLACKLIST_FILE_SCHEMA.fields]
    assert {r.passport_num for r in got.collect()} >= {"P1"}


def test_apply_by_marks_is_apply_and_shuffles_no_rows(spark):
    """A load whose staged rows are many shuffles keys, not rows; duplicates and NULL keys as in a MERGE."""
    for n_staged, mostly in ((3, False), (40, True)):
        target = spark.createDataFrame([(str(i % 45), f"old{i}") for i in range(50)] + [(None, "n")], "k string, v string")
        staged = spark.createDataFrame([(str(i + 2), f"new{i}") for i in range(n_staged)] + [("99", "x"), (None, "m")], "k string, v string")
        keys = spark.createDataFrame([(str(i),) for i in range(60) if i % 7] + [("1",), ("99",), (None,)], "id string")
        counts = key_counts(target, staged, keys, "k")
        twice = {r["k"] for r in counts.where("n_target > 1").collect()}
        assert twice == {str(i) for i in range(5)}
        for wanted in (mostly, not mostly):  # either way is right; one marks fewer keys
            got = scd1_apply_marked(target, staged, key_marks(counts, "k", wanted), "k", wanted)
            expect = scd1_apply(target, staged, keys, "k")
            assert sorted(map(str, got.collect())) == sorted(map(str, expect.collect()))
        pinned = spark.createDataFrame(key_marks(counts, "k", mostly).collect(), "k string, n_target long, staged boolean, gone boolean")
        plan = scd1_apply_marked(target, staged, pinned, "k", mostly)
        plan.collect()
        assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()


def test_a_key_staged_twice_fails_the_load(spark, workdir):
    """H15, also for a dimension whose keys are counted by the merge."""
    from fraudmart.operators.scd1 import DuplicateKeyError
    from fraudmart.plans.daily import Warehouse

    clients = spark.createDataFrame([("1", "a"), ("2", "b")], "client_id string, last_name string")
    stamp = F.lit("2020-01-01").cast("timestamp_ntz")

    def whole(df, schema):
        return df.select(*[F.col(f.name) if f.name in df.columns else (stamp if f.name == "create_dt" else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])

    sources = {"clients": whole(clients, schemas.CLIENTS), "accounts": spark.createDataFrame([], schemas.ACCOUNTS), "cards": spark.createDataFrame([], schemas.CARDS)}
    wh = Warehouse(spark, workdir + "/wh")
    wh.initial_load(sources)
    with pytest.raises(DuplicateKeyError, match="'2' x2"):
        wh.increment(sources | {"clients": whole(clients.union(clients.where("client_id = '2'")), schemas.CLIENTS)}, {}, "2021-01-01 00:00:00")
    wh.increment(sources, {}, "2021-01-01 00:00:00")
    assert wh.read_table("dim_clients").count() == 2


def test_bitmaps_keep_flagged_cards_and_drop_most_others(spark):
    cards = spark.range(0, 60000, 3).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("card_num"))
    tx = spark.range(60000).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("card_num"), "id").union(
        spark.createDataFrame([(None, -1)], "card_num string, id long")
    )
    kept = of_known_cards(tx, cards)
    assert kept.columns == tx.columns
    assert kept.where("id % 3 = 0").count() == 20000
    assert kept.where("id % 3 <> 0").count() < 40000 / 4
    assert of_known_cards(tx, cards.limit(0)).count() == 0
