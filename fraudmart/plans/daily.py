"""The warehouse jobs: initial load, daily increment, fraud report.

Order of one increment (as in the reference): capture into staging, append facts,
upsert dimensions, snapshot source keys, delete vanished keys, advance the
watermarks, then publish (commit 1).  The report is built from the published
state and published on its own (commit 2).

Staging is *pinned*: each staging frame is written once under the shared
``spark.checkpoint.dir`` and read back, because it feeds the fact append or the
MERGE, the watermark MAX and the duplicate check.  That cuts lineage (a lost
executor recomputes from the pinned files, not from the sources) and freezes a
source that changes while the run is going.
"""

from __future__ import annotations

import datetime as _dt
import logging
import os
import time
from dataclasses import dataclass, field
from contextlib import contextmanager
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed, wait
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart import schemas
from fraudmart.functions import enforce_varchar, to_stamp_text
from fraudmart.operators.capture import (
    capture_accounts,
    capture_blacklist,
    capture_cards,
    capture_clients,
    capture_terminals,
    capture_transactions,
    initial_load,
    source_keys,
)
from fraudmart.operators.broadcast import observed_size
from fraudmart.operators.files import FILE_KEY, oldest_drop, require_feeds, unseen_files
from fraudmart.operators.report import fraud_report, fraud_report_measured
from fraudmart.operators.scd1 import assert_unique_keys, key_counts, key_marks, scd1_apply_marked, scd1_apply_vanished, scd1_upsert
from fraudmart.operators.watermarks import SEED_STAMP, advanced_values, as_of_now, observed_max, watermark_values
from fraudmart.plans.catalog import TRANSACTIONS, Catalog
from fraudmart.plans.store import CLEAR_REPORT, DROP, LOAD, REPORT, PublishRecord, Store, new_attempt, part_of
from fraudmart.session import remove_path, scratch_path
from fraudmart.sources.listing import archive_drops, list_drop_files
from fraudmart.sources.text import RAW_SCHEMA, read_feed_text, read_transactions
from fraudmart.sources.xlsx import BLACKLIST_FILE_SCHEMA, TERMINALS_FILE_SCHEMA, read_blacklist, read_terminals

log = logging.getLogger("fraudmart")


@contextmanager
def _step(name: str):
    """Log one step of a run with its wall time (the reference prints 'ok')."""
    t0 = time.perf_counter()
    yield
    log.info("%s: ok (%.1f s)", name, time.perf_counter() - t0)


SOURCE_OF_DIM = {"dim_clients": "clients", "dim_accounts": "accounts", "dim_cards": "cards"}
# Drop-file feed -> the table whose watermark gates it.
FEED_TABLES = {
    "terminals": "dim_terminals",
    "passport_blacklist": "fact_passport_blacklist",
    "transactions": "fact_transactions",
}


@dataclass(frozen=True)
class Written:
    """What a write saw of its rows."""

    rows: int
    newest: str | None = None
    parts: set[str] = field(default_factory=set)
    bytes: int | None = None  # in memory, as a broadcast


class Warehouse:
    """One warehouse root.  ``sources`` maps ``clients/accounts/cards`` to frames
    (see :func:`fraudmart.sources.tables.read_source`)."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        broadcast_limit_bytes: int = 256 * 1024 * 1024,
        parallel_jobs: int = 4,
        database: str | None = None,
        buckets: int = 64,
    ):
        self.spark = spark
        self.store = Store(spark, root)
        # With a database, the tables are in the catalog, too, and the transactions are bucketed by card.
        self.catalog = Catalog(self.store, database, buckets) if database else None
        # Independent jobs of one step (pins, checks, table writes) are submitted
        # from this many driver threads at once; the cluster schedules them.
        self.parallel_jobs = parallel_jobs
        # In-memory size up to which the flagged cards are broadcast to the
        # transactions scan (measured, see operators.broadcast).
        self.broadcast_limit_bytes = broadcast_limit_bytes
        self.last_relevant_bytes: int | None = None
        self._pool: ThreadPoolExecutor | None = None

    # -- helpers ---------------------------------------------------------
    def _write(self, df: DataFrame, write: Callable[[DataFrame], object], name: str, part: Column | None = None) -> Written:
        """Write ``df``; its rows, newest change time and parts are observed by the write itself."""
        seen = Observation(f"{name}-{new_attempt()}")
        facts = [F.count(F.lit(1)).alias("n")]
        if "create_dt" in df.columns:
            facts.append(observed_max(df).alias("newest"))
        if part is not None:
            facts.append(F.collect_set(part).alias("parts"))  # at most n_parts numbers
            facts.append(observed_size(df).alias("bytes"))
        write(df.observe(seen, *facts))
        values = seen.get
        return Written(int(values["n"]), values.get("newest"), {str(p) for p in values.get("parts") or ()}, values.get("bytes"))

    def _pin(self, df: DataFrame, batch_id: int, attempt: str, name: str, part: Column | None = None) -> tuple[DataFrame, Written]:
        """Write ``df`` once under the shared checkpoint folder and read it back."""
        path = scratch_path(self.spark, "fraudmart-staging", f"{batch_id}-{attempt}", name)
        written = self._write(df, lambda d: d.write.mode("errorifexists").option("compression", schemas.COMPRESSION).parquet(path), name, part)
        return self.spark.read.schema(df.schema).parquet(path), written

    def _all(self, jobs: dict[str, Callable[[], object]]) -> dict[str, object]:
        """Run independent Spark jobs concurrently; the first failure cancels the others and is raised.

        All jobs of a call carry one tag, by which they are cancelled, and run in one pool of
        the fair scheduler (where the session has one), so a long job doesn't hold up short ones.
        """
        sc, tag = self.spark.sparkContext, f"fraudmart-{new_attempt()}"

        def run(name: str, job: Callable[[], object]) -> object:
            sc.addJobTag(tag)
            sc.setLocalProperty("spark.scheduler.pool", "fraudmart")
            sc.setJobDescription(f"fraudmart: {name}")
            try:
                return job()
            finally:
                sc.removeJobTag(tag)
                sc.setLocalProperty("spark.scheduler.pool", None)
                sc.setJobDescription(None)

        if self._pool is None:  # its threads, each with a connection to the JVM, live as long as the warehouse
            self._pool = ThreadPoolExecutor(max_workers=max(1, self.parallel_jobs))
        futures = {self._pool.submit(run, name, job): name for name, job in jobs.items()}
        for done in as_completed(futures):
            if done.cancelled() or done.exception() is None:
                continue
            for other in futures:
                other.cancel()
            while not all(other.done() for other in futures):  # also what a thread submits next
                sc.cancelJobsWithTag(tag)
                wait(futures, timeout=0.2)
            raise done.exception()
        return {name: future.result() for future, name in futures.items()}

    def _load_dim(
        self, dim: str, state: PublishRecord, staged: tuple[DataFrame, Written], keys: DataFrame | None, batch_id: int, attempt: str
    ) -> dict[str, str]:
        """C9-C16 on the parts of a dimension that change; the others keep their files.  Returns part -> version.

        ``staged`` and ``keys``, the source's keys for a dimension that takes deletes, are pinned.
        """
        _schema, key = schemas.DIMENSIONS[dim]
        (frame, written), known, part = staged, state.parts.get(dim, {}), part_of(key, state.n_parts)
        parts, marks, mostly = written.parts, None, False
        if keys is not None:
            whole = self.store.dim_of(dim, state)
            mostly = 2 * written.rows > whole.count()
            twice = Observation(f"twice-{dim}-{attempt}")
            counts = key_counts(whole, frame, keys, key).observe(twice, F.max("n_staged").alias("n"))
            gone_part = F.when(F.col("gone"), part)
            marks, left = self._pin(key_marks(counts, key, mostly), batch_id, attempt, f"marks_{dim}", gone_part)
            if (twice.get["n"] or 0) > 1:
                assert_unique_keys(frame, key)
            parts = parts | left.parts
        if not parts:
            return known
        current = self.store.dim_of(dim, state, parts)
        if marks is None:
            new = scd1_upsert(current, frame, key)
        elif left.bytes <= self.broadcast_limit_bytes:  # only keys are broadcast, and neither side's rows are shuffled
            new = scd1_apply_marked(current, frame, marks, key, mostly)
        else:
            new = scd1_apply_vanished(current, frame, marks.where("gone").select(key), key)
        return {p: v for p, v in known.items() if p not in parts} | self._write_dim(dim, new, batch_id, attempt, state.n_parts)

    def _write_dim(self, dim: str, df: DataFrame, batch_id: int, attempt: str, n_parts: int) -> dict[str, str]:
        """Write the rows of some whole parts of a dimension; returns part -> version of those that have any."""
        version = f"{batch_id}-{attempt}"
        part = part_of(schemas.DIMENSIONS[dim][1], n_parts)
        written = self._write(df, lambda d: self.store.write_dim(dim, d, version, n_parts), dim, part)
        return {p: version for p in written.parts}

    # -- S14, C23, C24 -----------------------------------------------------
    def initial_load(self, sources: dict[str, DataFrame], seed: str = SEED_STAMP) -> PublishRecord:
        """Create all tables: dimensions copied in full, terminals and facts empty,
        every watermark at the seed (which makes the first increment recapture the
        whole source; MERGE makes that harmless, H23)."""
        self.store.refresh()
        batch_id, attempt = self.store.next_batch_id(), new_attempt()
        checks: dict[str, Callable[[], object]] = {}
        writes: dict[str, Callable[[], object]] = {}
        for dim, (schema, key) in schemas.DIMENSIONS.items():
            src = sources.get(SOURCE_OF_DIM.get(dim, ""))
            if src is None:
                df = self.spark.createDataFrame([], schema)
            else:
                df = enforce_varchar(initial_load(src, schema), schemas.VARCHAR_LIMIT)
                checks[dim] = partial(assert_unique_keys, df, key)
            writes[dim] = partial(self._write_dim, dim, df, batch_id, attempt, self.store.dim_parts)
        self._all(checks)
        parts = self._all(writes)
        rec = PublishRecord(
            batch_id=batch_id,
            kind=LOAD,
            attempt=attempt,
            versions={dim: f"{batch_id}-{attempt}" for dim in parts},
            parts=parts,
            n_parts=self.store.dim_parts,
            watermarks={t: to_stamp_text(seed) for t in schemas.WATERMARKED},
        )
        self.store.write_record(rec)
        self.sync_catalog()
        return rec

    # -- C19 ---------------------------------------------------------------
    def increment(
        self,
        sources: dict[str, DataFrame],
        feeds: dict[str, DataFrame | None],
        load_ts: str | _dt.datetime | None = None,
        files: dict[str, tuple] | None = None,
    ) -> PublishRecord:
        """Capture, load, delete, advance and publish one batch.

        ``feeds`` maps ``terminals / passport_blacklist / transactions`` to the read
        file frames (missing or ``None``: nothing staged for that feed); ``files``
        maps the same feeds to the (name, length, modified) of their drop files.  A file enters
        the ledger only when its feed's gate (load time after the watermark, H24)
        was open, so a gated-out file is picked again by the next run.
        """
        self.store.refresh()
        state = self.store.state()
        if state is None:
            raise RuntimeError("warehouse not initialised: run initial_load first")
        load_ts = to_stamp_text(load_ts or as_of_now())
        batch_id, attempt = self.store.next_batch_id(), new_attempt()
        control = self.store.control_frame()
        known = watermark_values(control)
        wm = {t: known.get(t) for t in schemas.WATERMARKED}  # a missing row is NULL (H19)
        gate_open = {
            feed: wm[table] is not None and load_ts > wm[table]  # same-format stamps compare as text
            for feed, table in FEED_TABLES.items()
        }

        def feed(name: str, schema) -> DataFrame:
            df = feeds.get(name)
            return df if df is not None else self.spark.createDataFrame([], schema)

        staged_raw = {
            "dim_clients": capture_clients(sources["clients"], wm["dim_clients"]),
            "dim_accounts": capture_accounts(sources["accounts"], wm["dim_accounts"]),
            "dim_cards": capture_cards(sources["cards"], wm["dim_cards"]),
            "dim_terminals": capture_terminals(
                feed("terminals", TERMINALS_FILE_SCHEMA), load_ts, wm["dim_terminals"]
            ),
            "fact_passport_blacklist": capture_blacklist(
                feed("passport_blacklist", BLACKLIST_FILE_SCHEMA), load_ts, wm["fact_passport_blacklist"]
            ),
            "fact_transactions": capture_transactions(
                feed("transactions", _typed_transactions_schema(RAW_SCHEMA)), load_ts, wm["fact_transactions"]
            ),
        }
        name, version = (batch_id, attempt), f"{batch_id}-{attempt}"

        # Dimension staging and key snapshots (C13) are pinned: each feeds several steps.  A fact is
        # staged by its attempt itself (C7, C8): written once, counted and its newest time seen by that
        # write, and recorded only if it holds rows.  All of them are independent.
        def pin_staged(table: str) -> tuple[DataFrame, Written]:
            part = part_of(schemas.DIMENSIONS[table][1], state.n_parts)
            return self._pin(enforce_varchar(staged_raw[table], schemas.VARCHAR_LIMIT), *name, table, part)

        def pin_keys(dim: str) -> tuple[DataFrame, Written]:
            return self._pin(source_keys(sources[SOURCE_OF_DIM[dim]], schemas.DIMENSIONS[dim][1]), *name, f"keys_{dim}")

        def append(table: str) -> tuple[dict[str, str], Written]:
            frame = enforce_varchar(staged_raw[table], schemas.VARCHAR_LIMIT)
            if self.catalog and table == TRANSACTIONS:  # read three times, so pinned
                pinned, written = self._pin(frame, *name, table)
                return self.catalog.append_transactions(pinned, written.rows, *name) if written.rows else {}, written
            written = self._write(frame, lambda df: self.store.append_fact(table, df, *name), table)
            return {table: attempt} if written.rows else {}, written

        jobs = {t: partial(append if t in schemas.FACTS else pin_staged, t) for t in staged_raw}
        jobs.update({f"keys_{dim}": partial(pin_keys, dim) for dim in schemas.DELETABLE})
        with _step("stage"):
            staged = self._all(jobs)
        counts = {table: staged[table][1].rows for table in staged_raw}

        # dimensions (C9-C16), independent of each other; a staged key that is there twice fails the run before
        # anything is published (H15), which a dimension that takes deletes sees as it counts its keys
        def load_dim(dim: str) -> dict[str, str]:
            snapshot = staged[f"keys_{dim}"][0] if dim in schemas.DELETABLE else None
            return self._load_dim(dim, state, staged[dim], snapshot, *name)

        loads = {dim: partial(load_dim, dim) for dim in schemas.DIMENSIONS}
        checks = {
            f"check_{dim}": partial(assert_unique_keys, staged[dim][0], key)
            for dim, (_schema, key) in schemas.DIMENSIONS.items()
            if counts[dim] and dim not in schemas.DELETABLE
        }
        with _step("load"):
            done = self._all(checks | loads)
        parts = {dim: done[dim] for dim in schemas.DIMENSIONS}
        changed = {dim: version for dim in parts if parts[dim] != state.parts.get(dim, {})}
        watermarks = advanced_values(known, {table: staged[table][1].newest for table in staged_raw})

        rec = PublishRecord(
            batch_id=batch_id,
            kind=LOAD,
            attempt=attempt,
            load_ts=load_ts,
            versions=state.versions | changed,
            parts=parts,
            n_parts=state.n_parts,
            watermarks={**state.watermarks, **{t: stamp for t, stamp in watermarks.items() if stamp}},
            facts={name: made for t in schemas.FACTS for name, made in staged[t][0].items()},
            file_ids=sorted(key for feed, key in (files or {}).items() if gate_open[feed]),
            counts=counts,
        )
        rec.files = [name for name, _length, _modified in rec.file_ids]
        self.store.write_record(rec)  # commit 1
        self.sync_catalog()
        remove_path(self.spark, scratch_path(self.spark, "fraudmart-staging", f"{batch_id}-{attempt}"))
        self.store.prune()
        return rec

    def sync_catalog(self) -> None:
        """Make the catalog, if there is one, show what the newest records name (S14); safe to repeat."""
        if self.catalog:
            self.catalog.create()
            self.catalog.sync()

    # -- C22 ---------------------------------------------------------------
    def report_frame(self, as_of: str | _dt.datetime, pin_as: str | None = None) -> DataFrame:
        """The report over the published state.

        With ``pin_as``, the flagged cards are pinned, measured, and broadcast
        when they fit ``broadcast_limit_bytes``, so the transactions fact is
        never shuffled; otherwise the plan is the shuffle join.
        """
        s, as_of = self.store, to_stamp_text(as_of)
        if self.catalog and pin_as is not None:
            self.sync_catalog()
            path = scratch_path(self.spark, "fraudmart-staging", pin_as, "relevant_cards")
            report, self.last_relevant_bytes = self.catalog.fraud_report(as_of, path, self.broadcast_limit_bytes)
            return report
        tables = [s.dim("dim_clients"), s.dim("dim_accounts"), s.dim("dim_cards"), s.fact("fact_transactions")]
        tables.append(s.fact("fact_passport_blacklist"))
        if pin_as is None:
            return fraud_report(*tables, as_of)
        path = scratch_path(self.spark, "fraudmart-staging", pin_as, "relevant_cards")
        report, self.last_relevant_bytes = fraud_report_measured(*tables, as_of, path, self.broadcast_limit_bytes)
        return report

    def build_report(self, as_of: str | _dt.datetime | None = None) -> PublishRecord:
        """Append one full report (H27) and publish it (commit 2)."""
        as_of = to_stamp_text(as_of or as_of_now())
        self.store.refresh()
        batch_id, attempt = self.store.next_batch_id(), new_attempt()
        with _step("report"):
            n = self.store.append_report(self.report_frame(as_of, pin_as=f"{batch_id}-{attempt}"), batch_id, attempt, as_of[:10])
        rec = PublishRecord(batch_id=batch_id, kind=REPORT, attempt=attempt, load_ts=as_of, counts={"rep_fraud": n})
        self.store.write_record(rec)
        self.sync_catalog()
        remove_path(self.spark, scratch_path(self.spark, "fraudmart-staging", f"{batch_id}-{attempt}"))
        return rec

    # -- S15, S16, S17 -----------------------------------------------------
    def clear_report(self) -> None:
        self.store.refresh()
        self.store.write_record(PublishRecord(self.store.next_batch_id(), CLEAR_REPORT, new_attempt()))
        self.sync_catalog()

    def vacuum(self, retain_hours: float = 7 * 24) -> list[str]:
        """Remove data of dropped and cleared batches, and of runs that never published, once it is that old."""
        self.store.refresh()
        return self.store.vacuum(retain_hours)

    def drop_all(self) -> None:
        """Every table reads as absent/empty afterwards; ``vacuum`` removes the files when they are old enough."""
        self.store.refresh()
        self.store.write_record(PublishRecord(self.store.next_batch_id(), DROP, new_attempt()))
        if self.catalog:
            self.catalog.drop()

    def read_report(self, day: str) -> DataFrame:
        """The report runs of one report date: one partition is read."""
        self.store.refresh()
        return self.store.report(day)

    def read_table(self, name: str) -> DataFrame:
        self.store.refresh()
        if name in schemas.DIMENSIONS:
            return self.store.dim(name)
        if name in schemas.FACTS:
            return self.store.fact(name)
        if name == "rep_fraud":
            return self.store.report()
        if name == "meta_loading":
            return self.store.control_frame()
        raise KeyError(name)

    def register_views(self) -> list[str]:
        """Temp views over the published state, for SQL inspection (S16):
        ``spark.sql("SELECT * FROM rep_fraud")``.  Re-register after a publish."""
        names = [*schemas.DIMENSIONS, *schemas.FACTS, "rep_fraud", "meta_loading"]
        for name in names:
            self.read_table(name).createOrReplaceTempView(name)
        return names

    # -- C25 ---------------------------------------------------------------
    def pick_drop_files(self, folder: str) -> dict[str, tuple[str, str, tuple]]:
        """S7 + S8: per feed the oldest file not yet ingested -> (name, path, ledger key)."""
        self.store.refresh()
        listing = list_drop_files(self.spark, folder)
        fresh = unseen_files(listing, self.store.ledger())
        # at most one drop a feed, each with what the ledger knows it by; one pass over the listing
        chosen = oldest_drop(fresh, more=("length", "modified")).collect()
        found = require_feeds(chosen)
        keys = {r["name"]: tuple(r[k] for k in FILE_KEY) for r in chosen}
        return {feed: (name, os.path.join(folder, name), keys[name]) for feed, (name, _date) in found.items()}

    def daily_run(
        self,
        sources: dict[str, DataFrame],
        folder: str,
        load_ts: str | _dt.datetime | None = None,
        as_of: str | _dt.datetime | None = None,
        archive: str | None = None,
    ) -> tuple[PublishRecord, PublishRecord]:
        """Pick files, run the increment, publish, build and publish the report.

        With ``archive``, drops that the ledger has are moved there after the publish (S8).
        """
        load_ts = to_stamp_text(load_ts or as_of_now())
        picked = self.pick_drop_files(folder)
        workbooks = {"terminals": (read_terminals, TERMINALS_FILE_SCHEMA), "passport_blacklist": (read_blacklist, BLACKLIST_FILE_SCHEMA)}
        feeds = {"transactions": read_transactions(self.spark, picked["transactions"][1])}
        for feed, (read, schema) in workbooks.items():
            name, path, _key = picked[feed]
            feeds[feed] = read(self.spark, path) if name.endswith(".xlsx") else read_feed_text(self.spark, path, schema)
        files = {feed: key for feed, (_name, _path, key) in picked.items()}
        load = self.increment(sources, feeds, load_ts, files)
        if archive:
            archive_drops(self.spark, folder, archive, self.store.ledger())
        report = self.build_report(as_of or load_ts)
        return load, report


def _typed_transactions_schema(raw_schema: T.StructType) -> T.StructType:
    types = {"trans_date": T.TimestampNTZType(), "amt": schemas.AMT}
    return T.StructType([T.StructField(f.name, types.get(f.name, f.dataType), True) for f in raw_schema.fields])
