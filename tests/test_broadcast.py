"""Measured broadcast of the flagged cards in the daily report."""

import os

from fraudmart.operators.broadcast import broadcast_if_small, measured_size
from fraudmart.plans.daily import Warehouse
from plan_text import plan_text
from test_daily import _drop, _sources


def test_measured_size(spark):
    df = spark.createDataFrame([("abc", 1), ("abcdefghi", 2), (None, 3)], "s string, n int")
    # per row: 8 (null bits) + 2*8 (fields) + payload rounded to 8 bytes; x2 for the hash relation
    assert measured_size(df) == 2 * ((24 + 8) + (24 + 16) + (24 + 0))
    small, size = broadcast_if_small(df, 10_000)
    assert "BroadcastExchange" in plan_text(small.join(spark.range(3).selectExpr("CAST(id AS INT) n"), "n"))
    big, _ = broadcast_if_small(df, 10)
    assert big is df and size > 10


def test_report_broadcasts_small_flagged_set(spark, workdir):
    drops = os.path.join(workdir, "drops")
    _drop(drops, 1, [("1", "2021-01-01 09:00:00", "1", "K1", "PAY", "OK", "T1"),
                     ("2", "2021-01-01 09:30:00", "2", "K3", "PAY", "OK", "T1")], listed=["P2"])
    results = {}
    for limit in (1 << 30, 0):
        wh = Warehouse(spark, os.path.join(workdir, f"wh{limit}"), broadcast_limit_bytes=limit)
        src = _sources(spark, ["1", "2", "3"])
        wh.initial_load(src)
        wh.daily_run(src, drops, "2021-01-01 23:00:00")
        frame = wh.report_frame("2021-01-01 23:00:00", pin_as=f"probe-{limit}")
        plan = plan_text(frame, "formatted")
        if limit:
            assert wh.last_relevant_bytes and wh.last_relevant_bytes < limit
            assert "BroadcastHashJoin" in plan.split("== Physical Plan ==")[-1]
        results[limit] = sorted(map(tuple, wh.read_table("rep_fraud").drop("report_dt").collect()))
    assert results[1 << 30] == results[0] and len(results[0]) == 2
