"""Warehouse storage with an atomic publish.

Parquet accepts neither MERGE, DELETE nor UPDATE, and a path cannot be overwritten
while it is read.  So every write goes to a *new* location and a small publish
record, created last, says which locations are current:

    <root>/dims/<table>/v=<batch>-<attempt>/part=<p>/       rows of one part of a dimension
    <root>/facts/<table>/batch_id=<b>/attempt=<a>/          appended rows
    <root>/report/rep_fraud/report_date=<d>/batch_id=<b>/attempt=<a>/   one full report per run
    <root>/_control/<batch>.json                            publish record (see commits.py)

A load record (``kind = load``) carries the version of every part of the dimensions, the fact
attempts, the watermarks and the drop files it consumed: it is the reference's
first commit plus the file archive step (H26).  A report record is the second
commit.  Readers resolve the newest record, so a crash before a record is created
leaves the previous state fully visible, and a rerun writes a fresh attempt.

A dimension is cut into ``dim_parts`` parts by hash of its key.  A load writes only the parts
it changes; its record names the files of the others where they are (D3, D4).

What no record names is removed by listing: versions that fell out of the newest
``keep_versions`` states of a table after each publish, and attempts, reports and
everything dropped or cleared by ``vacuum`` once it is old enough (S15, D5).

Records are tiny (one a run): the log is read once per operation and
resolved on the driver in plain Python, a bound set by the number of runs, never
by data.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart import schemas
from fraudmart.plans.commits import FOLD_EVERY, Log
from fraudmart.session import matching_paths, remove_path

FILE_ID = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("length", T.LongType()), T.StructField("modified", T.LongType())]
)
LOAD = "load"
REPORT = "report"
CLEAR_REPORT = "clear_report"
DROP = "drop"
# Suffix of a fact's attempts that are written in buckets (see catalog.py).
BUCKETED = "_by_card"


@dataclass
class PublishRecord:
    batch_id: int
    kind: str
    attempt: str
    load_ts: str | None = None
    versions: dict[str, str] = field(default_factory=dict)
    # table -> part -> version that holds its rows; a part without rows is absent
    parts: dict[str, dict[str, str]] = field(default_factory=dict)
    n_parts: int = 0
    watermarks: dict[str, str] = field(default_factory=dict)
    facts: dict[str, str] = field(default_factory=dict)
    files: list[str] = field(default_factory=list)
    # (name, length, modified) of the same files: what the ledger knows them by
    file_ids: list[tuple] = field(default_factory=list)
    # rows staged per table (load) or written (report): the run's progress log
    counts: dict[str, int] = field(default_factory=dict)


def new_attempt() -> str:
    # A letter first, so partition discovery can never read it as a number.
    return "a" + uuid.uuid4().hex[:12]


def part_of(key: str, n_parts: int) -> Column:
    """The part of a dimension that a row belongs to; rows without a key have one, too."""
    return F.pmod(F.hash(F.col(key)), F.lit(n_parts))


def report_date(rec: PublishRecord) -> str:
    return (rec.load_ts or "")[:10]


def _with_partition_columns(schema: T.StructType) -> T.StructType:
    return T.StructType(
        list(schema.fields)
        + [T.StructField("batch_id", T.LongType(), True), T.StructField("attempt", T.StringType(), True)]
    )


class Store:
    """Paths and readers of one warehouse root (a shared filesystem path)."""

    def __init__(self, spark: SparkSession, root: str, keep_versions: int = 3, dim_parts: int = 16, fold_every: int = FOLD_EVERY):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_versions = max(1, keep_versions)
        # parts of a dimension written by the next loads; a table keeps the number it began with
        self.dim_parts = max(1, dim_parts)
        self.fold_every = fold_every
        self._records: list[PublishRecord] | None = None

    # -- paths ---------------------------------------------------------
    def dim_path(self, table: str, version: str) -> str:
        return f"{self.root}/dims/{table}/v={version}"

    def fact_path(self, table: str) -> str:
        return f"{self.root}/facts/{table}"

    def report_path(self) -> str:
        return f"{self.root}/report/rep_fraud"

    def control_path(self) -> str:
        return f"{self.root}/_control"

    # -- publish records -------------------------------------------------
    def log(self) -> Log:
        return Log(self.spark, self.control_path(), self.fold_every, self._slim)

    def _slim(self, records: list[dict]) -> list[dict]:
        """What a checkpoint keeps: only loads that a state can still be read from need their parts and counts."""
        loads = [r["batch_id"] for r in records if r["kind"] == LOAD]
        whole = set(loads[-4 * self.keep_versions :])
        gone = {"versions": {}, "parts": {}, "watermarks": {}, "counts": {}}
        return [r if r["kind"] != LOAD or r["batch_id"] in whole else {**r, **gone} for r in records]

    def refresh(self) -> None:
        """Forget the records read so far (call at the start of an operation)."""
        self._records = None

    def records(self) -> list[PublishRecord]:
        """All publish records, read once per operation; writing a record drops this copy."""
        if self._records is None:
            self._records = [PublishRecord(**{**r, "file_ids": [tuple(f) for f in r["file_ids"]]}) for r in self.log().read()]
        return self._records

    def committed(self, kinds: tuple[str, ...], after: int = -1) -> list[PublishRecord]:
        """The records of some kinds with a larger batch id than ``after``, in batch order."""
        return [r for r in self.records() if r.kind in kinds and r.batch_id > after]

    def latest(self, kinds: tuple[str, ...]) -> PublishRecord | None:
        """Newest record of the given kinds."""
        return next(reversed(self.committed(kinds)), None)

    def write_record(self, rec: PublishRecord) -> None:
        """The commit point: one file, created in one step; of two writers of a batch id one fails."""
        self.log().append(asdict(rec))
        self.refresh()

    # -- what is no longer named ---------------------------------------------
    def _kept_parts(self) -> set[tuple[str, str, str]]:
        """(table, version, part) of the newest ``keep_versions`` distinct states of every dimension."""
        kept: set[tuple[str, str, str]] = set()
        states: dict[str, list[dict[str, str]]] = {}
        for rec in reversed(self.committed((LOAD,), self._floor((DROP,)))):
            for table, parts in rec.parts.items():
                known = states.setdefault(table, [])
                if parts not in known and len(known) < self.keep_versions:
                    known.append(parts)
                    kept.update((table, version, part) for part, version in parts.items())
        return kept

    def _stale(self, pattern: str, live: set[tuple], after: int = -1) -> list[tuple[str, int]]:
        """(path, age in ms) of the folders that ``pattern`` matches, of batches later than ``after``, and no live record names.

        Folders of batches after the newest record belong to writers that are at work.
        """
        newest = self._newest()
        found = []
        for path, modified in matching_paths(self.spark, f"{self.root}/{pattern}"):
            names = path.removesuffix("/").split("/")[-pattern.count("/") - 1 :]
            values = dict(n.split("=", 1) for n in names if "=" in n)
            batch = int(values["v"].split("-")[0] if "v" in values else values["batch_id"])
            key = (names[1], *(values[k] for k in ("v", "part", "report_date", "batch_id", "attempt") if k in values))
            if after < batch <= newest and key not in live:
                found.append((path, int(time.time() * 1000) - modified))
        return found

    def _newest(self) -> int:
        records = self.records()
        return records[-1].batch_id if records else 0

    def prune(self) -> None:
        """Remove every part version that none of a table's newest ``keep_versions`` states names.

        A reader of an older state may be cut off, so keep more versions than the
        longest query lasts runs.  What was dropped stays until ``vacuum`` finds it old enough.
        """
        kept, floor = self._kept_parts(), self._floor((DROP,))
        had: dict[tuple[str, str], int] = {}  # parts a version began with, as far as records tell
        for rec in self.committed((LOAD,), floor):
            for table, parts in rec.parts.items():
                own = sum(v == rec.versions.get(table) for v in parts.values())
                had.setdefault((table, rec.versions.get(table, "")), own)
        for path, _modified in matching_paths(self.spark, f"{self.root}/dims/*/v=*"):
            table, version = path.split("/")[-2], path.rpartition("/v=")[2]
            live = {k for k in kept if k[:2] == (table, version)}
            if not floor < int(version.split("-")[0]) <= self._newest() or len(live) == had.get((table, version)):
                continue
            if not live:
                remove_path(self.spark, path)
                continue
            for stale, _age in self._stale(f"dims/{table}/v={version}/part=*", live, floor):
                remove_path(self.spark, stale)
        self.log().tidy()

    def _remove_empty_versions(self) -> None:
        held = {path.rpartition("/")[0] for path, _ in matching_paths(self.spark, f"{self.root}/dims/*/v=*/part=*")}
        for path, _ in matching_paths(self.spark, f"{self.root}/dims/*/v=*"):
            batch = int(path.rpartition("/v=")[2].split("-")[0])
            if path not in held and batch <= self._newest():
                remove_path(self.spark, path)

    def vacuum(self, retain_hours: float = 7 * 24) -> list[str]:
        """Physical drop (S15, D5): remove what no live record names once it is older than ``retain_hours``.

        That is data of dropped tables and cleared reports, and of attempts that were never published.
        Nothing that a live record names is touched, whatever its age.
        """
        floor, cleared = self._floor((DROP,)), self._floor((CLEAR_REPORT, DROP))
        facts = {(t, str(r.batch_id), a) for r in self.committed((LOAD,), floor) for t, a in r.facts.items()}
        reports = {("rep_fraud", report_date(r), str(r.batch_id), r.attempt) for r in self.committed((REPORT,), cleared)}
        patterns = {
            "dims/*/v=*/part=*": self._kept_parts(),
            "facts/*/batch_id=*/attempt=*": facts,
            "report/*/report_date=*/batch_id=*/attempt=*": reports,
        }
        removed = []
        for pattern, live in patterns.items():
            for path, age in self._stale(pattern, live):
                if age >= retain_hours * 3_600_000:
                    remove_path(self.spark, path)
                    removed.append(path)
        self._remove_empty_versions()
        return removed

    # -- writers -------------------------------------------------------
    def write_dim(self, table: str, df: DataFrame, version: str, n_parts: int | None = None) -> None:
        """Rows of the changed parts of a dimension, dealt by hash of its key."""
        _schema, key = schemas.DIMENSIONS[table]
        dealt = df.withColumn("part", part_of(key, n_parts or self.dim_parts))
        dealt.write.mode("errorifexists").option("compression", schemas.COMPRESSION).partitionBy("part").parquet(self.dim_path(table, version))

    def append_fact(self, table: str, df: DataFrame, batch_id: int, attempt: str) -> str:
        """Rows go to their own ``batch_id/attempt`` partition; a rerun writes a
        new attempt, and only the published attempt is ever read (H25)."""
        df.write.mode("errorifexists").option("compression", schemas.COMPRESSION).parquet(f"{self.fact_path(table)}/batch_id={batch_id}/attempt={attempt}")
        return attempt

    def append_report(self, df: DataFrame, batch_id: int, attempt: str, day: str) -> int:
        """The report of one run in its own partition; returns its row count (observed while writing).

        Files are sorted by passport and carry Bloom filters of it, so one client's rows are read from few row groups.
        """
        from pyspark.sql import Observation

        rows = Observation(f"report_{attempt}")
        (
            df.observe(rows, F.count(F.lit(1)).alias("n"))
            .sortWithinPartitions("passport", "event_dt")
            .write.mode("errorifexists")
            .option("compression", schemas.COMPRESSION)
            .option("parquet.bloom.filter.enabled#passport", "true")
            .parquet(f"{self.report_path()}/report_date={day}/batch_id={batch_id}/attempt={attempt}")
        )
        return int(rows.get["n"])

    # -- readers (S16) -------------------------------------------------
    def state(self) -> PublishRecord | None:
        rec = self.latest((LOAD, DROP))
        return None if rec is None or rec.kind == DROP else rec

    def dim(self, table: str) -> DataFrame:
        return self.dim_of(table, self.state())

    def dim_of(self, table: str, rec: PublishRecord | None, only: set[str] | None = None) -> DataFrame:
        """A dimension as a load record names it, or ``only`` some of its parts."""
        schema, _ = schemas.DIMENSIONS[table]
        parts = rec.parts.get(table, {}) if rec is not None else {}
        paths = [f"{self.dim_path(table, v)}/part={p}" for p, v in sorted(parts.items()) if only is None or p in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _read_partitions(self, base: str, schema: T.StructType, pairs: list[tuple[int, str]]) -> DataFrame:
        """Read only the published ``batch_id/attempt`` folders (no full listing)."""
        if not pairs:
            return self.spark.createDataFrame([], schema)
        paths = [f"{base}/batch_id={b}/attempt={a}" for b, a in pairs]
        data = self.spark.read.schema(_with_partition_columns(schema)).option("basePath", base).parquet(*paths)
        return data.select(*schemas.columns(schema))

    def fact(self, table: str) -> DataFrame:
        """Rows of all published attempts of a fact table (one per run, bounded)."""
        floor = self._floor((DROP,))
        loads = self.committed((LOAD,), floor)
        plain, *more = (
            self._read_partitions(self.fact_path(name), schemas.FACTS[table], [(r.batch_id, r.facts[name]) for r in loads if name in r.facts])
            for name in (table, table + BUCKETED)
            if name == table or any(name in r.facts for r in loads)
        )
        return plain.unionByName(more[0]) if more else plain

    def _floor(self, kinds: tuple[str, ...]) -> int:
        rec = self.latest(kinds)
        return rec.batch_id if rec is not None else -1

    def report(self, day: str | None = None) -> DataFrame:
        """Every published report run since the last clear; with ``day``, only the runs of one report date."""
        floor = self._floor((CLEAR_REPORT, DROP))
        runs = [r for r in self.committed((REPORT,), floor) if day is None or report_date(r) == day]
        if not runs:
            return self.spark.createDataFrame([], schemas.REP_FRAUD)
        base = self.report_path()
        paths = [f"{base}/report_date={report_date(r)}/batch_id={r.batch_id}/attempt={r.attempt}" for r in runs]
        schema = _with_partition_columns(schemas.REP_FRAUD).add("report_date", T.DateType())
        data = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        return data.select(*schemas.columns(schemas.REP_FRAUD), "report_date").drop("report_date")

    def control_frame(self) -> DataFrame:
        """The watermark table (``meta_loading``) of the newest load."""
        from fraudmart.operators.watermarks import DEFAULT_DB

        rec = self.state()
        rows = [(DEFAULT_DB, t, s) for t, s in sorted((rec.watermarks if rec else {}).items())]
        df = self.spark.createDataFrame(rows, "db_name string, table_name string, last_update string")
        return df.withColumn("last_update", F.col("last_update").cast("timestamp_ntz"))

    def ledger_files(self) -> list[tuple]:
        return [f for r in self.committed((LOAD,), self._floor((DROP,))) for f in r.file_ids]

    def ledger(self) -> DataFrame:
        """Drop files consumed by published loads (S8): name, length, modified."""
        return self.spark.createDataFrame(self.ledger_files(), FILE_ID)

    def next_batch_id(self) -> int:
        return self._newest() + 1
