"""Command line: the daily job as a scheduler would launch it.

    python -m fraudmart init   --warehouse W --clients P --accounts P --cards P
    python -m fraudmart daily  --warehouse W --clients P --accounts P --cards P --drops D [--load-ts T] [--as-of T]
    python -m fraudmart daily  --warehouse W --jdbc-url U --jdbc-prop user=me --clients T,COLUMN,LOW,HIGH --accounts ... --drops D
    python -m fraudmart report --warehouse W [--as-of T]
    python -m fraudmart show   --warehouse W --table rep_fraud [--limit N]
    python -m fraudmart sql    --warehouse W --query "SELECT event_type, count(*) FROM rep_fraud GROUP BY 1"

Sources are read with :func:`fraudmart.sources.tables.read_source` (``--format``
parquet by default), or with ``--jdbc-url`` from database tables that are each
given as table, partition column, lower and upper bound.  On a cluster, ``spark.checkpoint.dir`` must name a shared
folder (staging is pinned there).
"""

from __future__ import annotations

import argparse
import logging
import sys

from fraudmart.plans.daily import Warehouse
from fraudmart.session import build_session
from fraudmart.sources.tables import JdbcSource, read_source


def _jdbc(args, given: str) -> JdbcSource:
    parts = given.split(",")
    if len(parts) != 4:
        raise SystemExit(f"with --jdbc-url give a source as TABLE,COLUMN,LOW,HIGH: {given}")
    properties = dict(p.split("=", 1) for p in args.jdbc_prop)
    return JdbcSource(args.jdbc_url, *parts, partitions=args.jdbc_partitions, properties=properties)


def _sources(spark, args) -> dict:
    names = ("clients", "accounts", "cards")
    if args.jdbc_url:
        return {name: read_source(spark, name, jdbc=_jdbc(args, getattr(args, name))) for name in names}
    return {name: read_source(spark, name, getattr(args, name), fmt=args.format) for name in names}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="fraudmart")
    parser.add_argument("command", choices=["init", "daily", "report", "show", "sql"])
    parser.add_argument("--query")
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--clients")
    parser.add_argument("--accounts")
    parser.add_argument("--cards")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-prop", action="append", default=[], metavar="NAME=VALUE", help="connection property")
    parser.add_argument("--jdbc-partitions", type=int, default=64, help="queries a table is read by")
    parser.add_argument("--drops")
    parser.add_argument("--load-ts")
    parser.add_argument("--as-of")
    parser.add_argument("--table", default="rep_fraud")
    parser.add_argument("--limit", type=int, default=20)
    parser.add_argument("--master")
    parser.add_argument("--parallel-jobs", type=int, default=4, help="independent jobs submitted at once")
    parser.add_argument(
        "--broadcast-limit-mb", type=int, default=256, help="measured size up to which flagged cards are broadcast"
    )
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")

    spark = build_session(args.master)
    wh = Warehouse(
        spark,
        args.warehouse,
        broadcast_limit_bytes=args.broadcast_limit_mb * 1024 * 1024,
        parallel_jobs=args.parallel_jobs,
    )
    if args.command == "init":
        rec = wh.initial_load(_sources(spark, args))
        print(f"initial load published as batch {rec.batch_id}")
    elif args.command == "daily":
        load, report = wh.daily_run(_sources(spark, args), args.drops, args.load_ts, args.as_of)
        print(f"load batch {load.batch_id} ({', '.join(load.files)}), staged {load.counts}, "
              f"report batch {report.batch_id} ({report.counts.get('rep_fraud', 0)} rows)")
    elif args.command == "report":
        rec = wh.build_report(args.as_of)
        print(f"report published as batch {rec.batch_id}")
    elif args.command == "sql":
        wh.register_views()
        spark.sql(args.query).show(args.limit, truncate=False)
    else:
        wh.read_table(args.table).show(args.limit, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
