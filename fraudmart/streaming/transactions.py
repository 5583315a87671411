"""Stream entry for the transactions feed (SURVEY 7.4; an alternative to the
daily batch for C6 + C7, with the same capture, append and publish steps).

``readStream`` over the drop folder (CSV, ``;``, header, positional schema,
``maxFilesPerTrigger=1``) -> typing -> ``foreachBatch``: capture against the
current fact watermark, append the micro-batch as one fact attempt, advance the
watermark and publish a load record.  Every file lands exactly once:

* a replayed epoch finds its record already published and does nothing;
* rows of a file that the warehouse's ledger has (from the batch path, or a stream
  with another checkpoint) are left out;
* the load stamp is the clock's, but always later than the watermark, so the load
  gate (H24) never shuts out an epoch that the checkpoint then counts as consumed;
* without a watermark, or with a value that the table's columns can't hold, the
  epoch fails and is tried again.

Ordering caveat: the file source orders by modification time, not by the date in
the name, so the batch path (oldest drop first) stays the default.  Do not run
the stream at the same time as :meth:`Warehouse.daily_run` on one warehouse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fraudmart import schemas
from fraudmart.functions import enforce_varchar, to_stamp_text
from fraudmart.functions.stamps import next_second
from fraudmart.operators.capture import capture_transactions
from fraudmart.operators.watermarks import advance_watermarks, as_of_now, watermark_value
from fraudmart.plans.store import LOAD, PublishRecord, Store
from fraudmart.session import file_system, remove_path, scratch_path
from fraudmart.sources.listing import archive_drops
from fraudmart.sources.text import RAW_SCHEMA, type_transactions

FACT = "fact_transactions"
# Ledger rows up to which the micro-batch isn't shuffled to leave out known files.
BROADCAST_FILES = 100_000


def transactions_stream(spark: SparkSession, folder: str, archive: str | None = None) -> DataFrame:
    """Streaming frame of typed transactions, one drop file per trigger.

    With ``archive``, the file source moves a file there once the batch after its own is planned
    (``cleanSource``), under its whole path.
    """
    reader = spark.readStream.schema(RAW_SCHEMA)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    raw = (
        reader
        .option("sep", ";")
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("maxFilesPerTrigger", 1)
        .option("pathGlobFilter", "transactions*")
        .csv(folder)
    )
    file = F.struct(
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_size").alias("length"),
        F.unix_micros("_metadata.file_modification_time").alias("modified"),
    )
    return type_transactions(raw.withColumn("_file", file), "_file")


def load_stamp(watermark: str, now: str) -> str:
    """The clock, or the second after the watermark if the clock hasn't passed it."""
    return now if now > watermark else next_second(watermark)


def load_micro_batch(store: Store, batch: DataFrame, epoch_id: int, stream_id: str) -> PublishRecord | None:
    """Capture + append + publish one micro-batch; idempotent per epoch."""
    attempt = f"s{stream_id}e{epoch_id}"
    store.refresh()
    if any(r.attempt == attempt for r in store.committed((LOAD,))):
        return None  # replay of a published epoch
    state = store.state()
    if state is None:
        raise RuntimeError("warehouse not initialised: run initial_load first")
    control = store.control_frame()
    wm = watermark_value(control, FACT)
    if wm is None:
        raise RuntimeError(f"{FACT} has no watermark: nothing may be loaded (H19)")
    load_ts = load_stamp(wm, as_of_now())
    ledger = store.ledger()
    known = ledger.select(F.struct(*ledger.columns).alias("_file"))
    small = len(store.ledger_files()) <= BROADCAST_FILES
    fresh = batch.join(F.broadcast(known) if small else known, "_file", "left_anti")
    path = scratch_path(store.spark, "fraudmart-staging", attempt, FACT)
    raw = enforce_varchar(capture_transactions(fresh, load_ts, wm, "_file"), schemas.VARCHAR_LIMIT)
    raw.write.mode("overwrite").parquet(path)  # a replayed epoch rewrites its own staging
    pinned = store.spark.read.schema(raw.schema).parquet(path)
    files = sorted(tuple(r[0]) for r in pinned.select("_file").distinct().collect())  # maxFilesPerTrigger
    staged = pinned.drop("_file")
    batch_id = store.next_batch_id()
    facts = {FACT: store.append_fact(FACT, staged, batch_id, attempt)} if files else {}
    advanced = {r["table_name"]: to_stamp_text(r["last_update"]) for r in advance_watermarks(control, {FACT: staged}).collect()}
    rec = PublishRecord(
        batch_id=batch_id,
        kind=LOAD,
        attempt=attempt,
        load_ts=load_ts,
        versions=dict(state.versions),
        parts=dict(state.parts),
        n_parts=state.n_parts,
        watermarks={**state.watermarks, FACT: advanced[FACT]},
        facts=facts,
        files=[name for name, _length, _modified in files],
        file_ids=files,
    )
    store.write_record(rec)
    store.prune()
    remove_path(store.spark, scratch_path(store.spark, "fraudmart-staging", attempt))
    return rec


def start_transactions_stream(
    spark: SparkSession,
    folder: str,
    warehouse_root: str,
    checkpoint_location: str | None = None,
    stream_id: str = "tx",
    archive: str | None = None,
) -> StreamingQuery:
    """Run the stream until the folder is drained (``availableNow``).

    The source archives a file only when a later batch is planned, so the last one stays; after the
    stream has ended :func:`archive_consumed` moves what the ledger has and the source has left.
    """
    store = Store(spark, warehouse_root)
    location = checkpoint_location or scratch_path(spark, "fraudmart-stream", stream_id)
    return (
        transactions_stream(spark, folder, archive)
        .writeStream.foreachBatch(lambda df, epoch: load_micro_batch(store, df, epoch, stream_id))
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .start()
    )


def archive_consumed(spark: SparkSession, folder: str, warehouse_root: str, archive: str) -> list[str]:
    """Move the consumed files that the stream's source left in the folder; call it when the stream has ended.

    They go where the source itself puts a file: under its whole path below ``archive``.
    """
    _, home = file_system(spark, folder)
    inside = f"{archive.rstrip('/')}{home.toUri().getPath()}"
    return archive_drops(spark, folder, inside, Store(spark, warehouse_root).ledger())
