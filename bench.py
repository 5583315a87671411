"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]``, writing to the ``noop`` sink so
the whole plan executes without output cost: the median of
``$BENCH_REPEAT`` (default 3) runs.  Every query is warmed up once before any
is timed, so the first one does not pay for a cold JVM.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "fraud_report",
    "upsert_accounts",
    "delete_accounts",
    "advance_watermarks",
    "capture_transactions",
    "fraud_after_increment",
)


def prepare_drops(spark, sf_dir: str, folder: str) -> None:
    """One day's drop files derived from the fixture (setup, not timed): the
    whole transactions fact as ``;`` text with decimal commas, and the
    terminals and blacklist as workbooks."""
    import glob
    import shutil
    import tempfile

    from pyspark.sql import functions as F

    from fraudmart.fixtures import Fixture

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "tests"))
    from xlsx_writer import write_xlsx

    fx = Fixture(spark, sf_dir)
    tmp = tempfile.mkdtemp(prefix="fraudmart-bench-csv-")
    (
        fx.transactions.select(
            "trans_id",
            F.date_format("trans_date", "yyyy-MM-dd HH:mm:ss"),
            F.regexp_replace(F.col("amt").cast("string"), r"\.", ","),
            "card_num",
            "oper_type",
            "oper_result",
            "terminal",
        )
        .coalesce(1)
        .write.option("sep", ";")
        .option("header", True)
        .csv(f"{tmp}/tx")
    )
    os.makedirs(folder, exist_ok=True)
    shutil.copy(glob.glob(f"{tmp}/tx/part-*.csv")[0], f"{folder}/transactions_01012001.txt")
    terms = [tuple(r) for r in fx.terminals.collect()]
    write_xlsx(f"{folder}/terminals_01012001.xlsx", [["id", "type", "city", "address"], *map(list, terms)])
    listed = [(r.entry_dt, r.passport_num) for r in fx.blacklist.collect()]
    write_xlsx(f"{folder}/passport_blacklist_01012001.xlsx", [["date", "passport"], *map(list, listed)])


def time_daily_run(spark, sf_dir: str, repeat: int) -> float:
    """Median wall time of ``Warehouse.daily_run`` over the fixture sources, each
    run on a fresh warehouse initialised from the 'before' dimensions."""
    import tempfile

    from fraudmart.fixtures import Fixture
    from fraudmart.plans.daily import Warehouse

    fx = Fixture(spark, sf_dir)
    before = {"clients": fx.dim_clients_before, "accounts": fx.dim_accounts_before, "cards": fx.dim_cards_before}
    today = {"clients": fx.left_clients, "accounts": fx.left_accounts, "cards": fx.left_cards}
    drops = tempfile.mkdtemp(prefix="fraudmart-bench-drops-")
    prepare_drops(spark, sf_dir, drops)
    times = []
    for _ in range(repeat + 1):  # the first run is the warm-up
        wh = Warehouse(spark, tempfile.mkdtemp(prefix="fraudmart-bench-wh-"))
        wh.initial_load(before)
        t0 = time.perf_counter()
        wh.daily_run(today, drops, "2001-01-01 00:00:00")
        times.append(time.perf_counter() - t0)
    return statistics.median(times[1:])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))

    from fraudmart.queries import QUERIES
    from fraudmart.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="fraudmart-bench", shuffle_partitions=int(cpus))

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:  # warm-up pass over every query: JIT, listing, footers
        run(name)
    timings: dict[str, float] = {}
    for name in HEADLINE:
        timings[name] = round(statistics.median(run(name) for _ in range(repeat)), 4)
    if os.environ.get("BENCH_DAILY", "1") == "1":
        # the whole daily job: read drops, stage, load, delete, publish, report
        timings["daily_run"] = round(time_daily_run(spark, sf_dir, repeat), 4)
    spark.stop()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_median_sum",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
