"""Catalog tables: found by name, only published rows, the bucketed fact joined where it is, heavy cards apart."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from fraudmart import queries, schemas
from fraudmart.plans import catalog
from fraudmart.plans.catalog import BY_CARD, PLAIN, buckets_for, heavy_cards
from fraudmart.plans.daily import Warehouse
from fraudmart.streaming.transactions import start_transactions_stream
from paths import SF_SMALL
from test_daily import _drop, _sources

TABLES = (*schemas.DIMENSIONS, *schemas.FACTS, "rep_fraud", "meta_loading")


def _database():
    return f"mart_{uuid.uuid4().hex[:8]}"


def _rows(df):
    return sorted(map(str, df.collect()))


def _loaded(spark, workdir, database, days=2, **options):
    wh = Warehouse(spark, os.path.join(workdir, "wh" if database else "plain"), database=database, buckets=4, **options)
    drops = os.path.join(workdir, "drops")
    src = _sources(spark, [str(k) for k in range(1, 31)])
    wh.initial_load(src)
    for day in range(1, days + 1):
        if not os.path.exists(os.path.join(drops, f"transactions_{day:02d}012021.txt")):
            # a third of the rows are of one card, some have none
            rows = [(f"{day}-{k}", "2021-01-01 09:00:00", "1", "K1" if k % 3 == 0 else f"K{k % 30 + 1}" if k % 17 else "", "PAY", "OK", "T1") for k in range(120)]
            _drop(drops, day, rows, listed=[f"P{day + 3}"])
        wh.daily_run(src, drops, f"2021-01-{day:02d} 23:00:00")
    return wh


def test_tables_by_name_are_the_published_state(spark, workdir):
    database = _database()
    wh = _loaded(spark, workdir, database)
    plain = _loaded(spark, workdir, None)
    for table in TABLES:
        by_name = spark.table(f"{database}.{table}")
        assert by_name.columns == wh.read_table(table).columns
        assert _rows(by_name) == _rows(wh.read_table(table)) == _rows(plain.read_table(table)), table
    assert spark.table(f"{database}.fact_transactions").count() == 240
    # an attempt that was never published is in no table
    wh.store.append_fact("fact_transactions", wh.read_table("fact_transactions"), 99, "acrashed")
    wh.sync_catalog()
    assert spark.table(f"{database}.fact_transactions").count() == 240
    wh.clear_report()
    assert spark.table(f"{database}.rep_fraud").count() == 0
    # another session's catalog is made again from the records
    wh.catalog.drop()
    assert not spark.catalog.databaseExists(database)
    wh.sync_catalog()
    assert spark.table(f"{database}.fact_transactions").count() == 240
    wh.drop_all()
    assert not spark.catalog.databaseExists(database)


def test_heavy_cards_and_rows_without_card_are_kept_apart(spark, workdir):
    database = _database()
    _loaded(spark, workdir, database, days=1)
    light, plain = spark.table(f"{database}.{BY_CARD}"), spark.table(f"{database}.{PLAIN}")
    assert {r.card_num for r in plain.select("card_num").distinct().collect()} == {"K1", None}
    assert light.where("card_num = 'K1' OR card_num IS NULL").count() == 0 and light.count() + plain.count() == 120
    counted = spark.range(1000).select(F.when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("card_num"))
    assert [r.card_num for r in heavy_cards(counted, 1000, 64).collect()] == ["hot"]


def _exchanges_over(plan: str, table: str) -> bool:
    """Whether a scan of ``table`` lies under an exchange before its first join (formatted tree, children deeper)."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if table in line and "Scan" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-*|"))
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-*|"))
        if own < depth:
            depth = own
            if "Join" in line:
                return False
            if "Exchange" in line:
                return True
    return False


@pytest.mark.parametrize("limit", [0, 1 << 28])
def test_report_does_not_move_the_bucketed_fact(spark, workdir, limit):
    database = _database()
    wh = _loaded(spark, workdir, database, broadcast_limit_bytes=limit)
    plain = _loaded(spark, workdir, None)
    want = _rows(plain.report_frame("2021-02-01 00:00:00"))
    got = wh.report_frame("2021-02-01 00:00:00", pin_as=uuid.uuid4().hex)
    executed = got._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in executed) == (limit == 0)
    assert "Bucketed: true" in executed or limit
    assert not _exchanges_over(executed, BY_CARD)
    assert _rows(got) == want and len(want) >= 3


def test_stream_loads_join_the_catalog(spark, workdir):
    """A stream writes plain attempts; the catalog and the report see them beside the bucketed ones."""
    database = _database()
    wh = _loaded(spark, workdir, database, days=1, broadcast_limit_bytes=0)
    feed = os.path.join(workdir, "feed")
    _drop(feed, 9, [(f"s{k}", "2021-01-09 09:00:00", "1", f"K{k + 1}", "PAY", "OK", "T1") for k in range(20)])
    start_transactions_stream(spark, feed, wh.store.root).awaitTermination()
    wh.sync_catalog()
    assert spark.table(f"{database}.fact_transactions").count() == 140 == wh.read_table("fact_transactions").count()
    got = _rows(wh.report_frame("2021-02-01 00:00:00", pin_as=uuid.uuid4().hex))
    assert got == _rows(wh.report_frame("2021-02-01 00:00:00")) and any("2021, 1, 9" in r for r in got)


def test_buckets_grow_in_number(spark, workdir, monkeypatch):
    """What a task reads of the bucketed fact doesn't grow with it."""
    assert [buckets_for(n) for n in (0, 600_000, 36_000_000, 216_000_000)] == [8, 8, 72, 432]
    seen = []

    class Seen(Warehouse):
        def __init__(self, *args, **options):
            seen.append(options["buckets"])
            super().__init__(*args, **options)

    monkeypatch.setattr(queries, "Warehouse", Seen)
    monkeypatch.setattr(catalog, "BUCKET_ROWS", 400)
    got = queries.q_fraud_report_bucketed(spark, SF_SMALL)
    assert seen == [-(-spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count() // 400)] and seen[0] > 8
    assert _rows(got) == _rows(queries.q_fraud_report(spark, SF_SMALL))
