"""Catalog tables of a warehouse: every table by name, the transactions bucketed by card.

The tables are Spark's own external Parquet tables over the warehouse's folders.  Their partitions
are what the publish records name, so the catalog never shows an unpublished attempt:

    dim_*                      parts of the dimension, one partition (part, version) each
    fact_transactions_by_card  bucketed and sorted by card_num
    fact_transactions_plain    not bucketed: rows of heavy cards and of no card, and stream loads
    fact_passport_blacklist    plain
    rep_fraud                  one partition (report_date, batch_id, attempt) a run

and views under the tables' plain names without the partition columns.

A join of the bucketed fact on ``card_num`` doesn't move it.  A bucket is read by one task, so a card with
more than 1 / (``HEAVY_PART`` * buckets) of a batch's rows is *heavy* and its rows are kept apart, in
files that any number of tasks read: at most ``HEAVY_PART`` * buckets cards of a batch can be heavy, which bounds their
broadcast, and what is left has no card that outweighs a bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.operators.broadcast import broadcast_if_small
from fraudmart.operators.report import events_of_persons, pinned_cards
from fraudmart.operators.watermarks import DEFAULT_DB
from fraudmart.plans.store import BUCKETED, CLEAR_REPORT, DROP, LOAD, REPORT, Store, new_attempt, report_date

TRANSACTIONS = "fact_transactions"
PLAIN = "fact_transactions_plain"
BY_CARD = TRANSACTIONS + BUCKETED
BLACKLIST = "fact_passport_blacklist"
#: A card is heavy from this part of a bucket's mean share on.
HEAVY_PART = 4
#: What flagged heavy cards may always take in a broadcast.
HEAVY_BYTES = 4 << 20
#: Transactions that a bucket, which one task reads, sorts and joins, holds of a load on average.
BUCKET_ROWS = 500_000


def buckets_for(rows: int, least: int = 8) -> int:
    """Buckets of a fact that begins with ``rows`` rows: the memory of a task doesn't grow with the fact."""
    return max(least, -(-rows // BUCKET_ROWS))


def heavy_cards(staged: DataFrame, rows: int, buckets: int, key: str = "card_num") -> DataFrame:
    """Keys with more than 1 / (``HEAVY_PART`` * buckets) of ``rows``: fewer than ``HEAVY_PART`` * buckets."""
    counted = staged.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") * HEAVY_PART * buckets > rows).select(key)


class Catalog:
    """The database of one warehouse.  ``sync`` makes it show what the newest records name."""

    def __init__(self, store: Store, database: str, buckets: int = 64):
        self.spark: SparkSession = store.spark
        self.store = store
        self.database = database
        self.buckets = buckets

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    # -- S14 -----------------------------------------------------------------
    def _create(self, table: str, schema, partitions: dict[str, str], location: str, clustered: str = "") -> None:
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
        columns += [f"`{name}` {kind}" for name, kind in partitions.items()]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({', '.join(columns)}) USING parquet "
            f"PARTITIONED BY ({', '.join(partitions)}) {clustered} LOCATION '{location}'"
        )

    def create(self) -> None:
        """All tables, without partitions yet."""
        store, by_batch = self.store, {"batch_id": "bigint", "attempt": "string"}
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        for dim, (schema, _key) in schemas.DIMENSIONS.items():
            self._create(f"{dim}_parts", schema, {"part": "int", "version": "string"}, f"{store.root}/dims/{dim}")
        clustered = f"CLUSTERED BY (card_num) SORTED BY (card_num) INTO {self.buckets} BUCKETS"
        self._create(BY_CARD, schemas.FACTS[TRANSACTIONS], by_batch, store.fact_path(BY_CARD), clustered)
        self._create(PLAIN, schemas.FACTS[TRANSACTIONS], by_batch, store.fact_path(TRANSACTIONS))
        self._create(f"{BLACKLIST}_batches", schemas.FACTS[BLACKLIST], by_batch, store.fact_path(BLACKLIST))
        self._create("rep_fraud_runs", schemas.REP_FRAUD, {"report_date": "date", **by_batch}, store.report_path())
        self._view(TRANSACTIONS, schemas.FACTS[TRANSACTIONS], BY_CARD, PLAIN)
        self._view(BLACKLIST, schemas.FACTS[BLACKLIST], f"{BLACKLIST}_batches")
        self._view("rep_fraud", schemas.REP_FRAUD, "rep_fraud_runs")
        for dim, (schema, _key) in schemas.DIMENSIONS.items():
            self._view(dim, schema, f"{dim}_parts")

    def _view(self, view: str, schema, *tables: str) -> None:
        columns = ", ".join(schemas.columns(schema))
        body = " UNION ALL ".join(f"SELECT {columns} FROM {self.name(t)}" for t in tables)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(view)} AS {body}")

    # -- S15 -----------------------------------------------------------------
    def drop(self) -> None:
        """Drop every table and view of the database, and the database; files stay for ``vacuum``."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")

    # -- published partitions --------------------------------------------------
    def _wanted(self) -> dict[str, dict[str, str]]:
        """table -> partition spec -> location, as the newest records say."""
        store, state = self.store, self.store.state()
        floor, cleared = store._floor((DROP,)), store._floor((CLEAR_REPORT, DROP))
        loads = store.committed((LOAD,), floor)
        wanted: dict[str, dict[str, str]] = {
            f"{dim}_parts": {
                f"part={p}/version={v}": f"{store.dim_path(dim, v)}/part={p}"
                for p, v in (state.parts.get(dim, {}) if state else {}).items()
            }
            for dim in schemas.DIMENSIONS
        }
        for table, fact in ((BY_CARD, BY_CARD), (PLAIN, TRANSACTIONS), (f"{BLACKLIST}_batches", BLACKLIST)):
            specs = [f"batch_id={r.batch_id}/attempt={r.facts[fact]}" for r in loads if fact in r.facts]
            wanted[table] = {spec: f"{store.fact_path(fact)}/{spec}" for spec in specs}
        runs = [f"report_date={report_date(r)}/batch_id={r.batch_id}/attempt={r.attempt}" for r in store.committed((REPORT,), cleared)]
        wanted["rep_fraud_runs"] = {spec: f"{store.report_path()}/{spec}" for spec in runs}
        return wanted

    @staticmethod
    def _spec(spec: str) -> str:
        values = (p.split("=", 1) for p in spec.split("/"))
        return "PARTITION (" + ", ".join(f"{k}='{v}'" for k, v in values) + ")"

    def sync(self) -> None:
        """Add the partitions that records name and the catalog lacks, and drop those no record names any more."""
        self.store.refresh()
        for table, wanted in self._wanted().items():
            name = self.name(table)
            known = {r.partition for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}  # one row a published batch
            gone = [self._spec(s) for s in sorted(known - set(wanted))]
            fresh = [f"{self._spec(s)} LOCATION '{wanted[s]}'" for s in sorted(set(wanted) - known)]
            if gone:
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(gone)}")
            if fresh:
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(fresh)}")
            if gone or fresh:
                self.spark.catalog.refreshTable(name)
        self._meta_view()

    def _meta_view(self) -> None:
        state = self.store.state()
        rows = ", ".join(f"('{DEFAULT_DB}', '{t}', timestamp_ntz'{s}')" for t, s in sorted((state.watermarks if state else {}).items()))
        body = f"SELECT * FROM VALUES {rows} AS t(db_name, table_name, last_update)" if rows else (
            "SELECT CAST(NULL AS string) AS db_name, CAST(NULL AS string) AS table_name, CAST(NULL AS timestamp_ntz) AS last_update WHERE false"
        )
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name('meta_loading')} AS {body}")

    # -- the bucketed fact -------------------------------------------------------
    def append_transactions(self, staged: DataFrame, rows: int, batch_id: int, attempt: str) -> dict[str, str]:
        """One attempt of the transactions: light cards bucketed, heavy ones apart.  ``staged`` is pinned.

        Returns what the publish record names.
        """
        heavy = F.broadcast(heavy_cards(staged, rows, self.buckets))  # fewer than HEAVY_PART * buckets rows
        light = staged.where(F.col("card_num").isNotNull()).join(heavy, "card_num", "left_anti")
        folder = f"{self.store.fact_path(BY_CARD)}/batch_id={batch_id}/attempt={attempt}"
        # Only a table can be written in buckets: a table of its own for the attempt's folder, whose entry goes at once.
        one = self.name(f"attempt_{new_attempt()}")
        columns = schemas.columns(schemas.FACTS[TRANSACTIONS])
        writer = light.select(*columns).repartition(self.buckets, "card_num").write.format("parquet")
        writer.bucketBy(self.buckets, "card_num").sortBy("card_num").option("path", folder).saveAsTable(one)
        self.spark.sql(f"DROP TABLE {one}")
        apart = staged.join(heavy, "card_num", "left_semi").unionByName(staged.where(F.col("card_num").isNull()))
        self.store.append_fact(TRANSACTIONS, apart.select(*columns), batch_id, attempt)
        return {TRANSACTIONS: attempt, BY_CARD: attempt}

    def fraud_report(self, as_of, pin_path: str, broadcast_limit_bytes: int) -> tuple[DataFrame, int]:
        """C22 over the catalog's tables, and the measured bytes of the flagged cards.

        Up to the limit the flagged cards are broadcast to both parts of the fact.  Beyond it they are
        shuffled to the buckets, and the bucketed part of the fact stays where it is.
        """
        table = self.spark.table
        dims = (table(self.name(d)) for d in ("dim_clients", "dim_accounts", "dim_cards", BLACKLIST))
        pinned, persons, size = pinned_cards(*dims, as_of, pin_path, broadcast_limit_bytes)
        bucketed, plain = table(self.name(BY_CARD)), table(self.name(PLAIN))
        cards = pinned
        if size > broadcast_limit_bytes:
            # few cards are heavy; those of stream loads may be many, then their rows are shuffled
            in_plain = pinned.join(plain.select("card_num").distinct(), "card_num", "left_semi")
            cards, _ = broadcast_if_small(in_plain, max(broadcast_limit_bytes, HEAVY_BYTES))
        return events_of_persons([(bucketed, pinned), (plain, cards)], persons, as_of), size

