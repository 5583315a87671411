"""Sharding over fixed virtual slots.

A record is hashed (id, text size, text CRC) into one of ``SLOTS`` virtual slots, a number
that never changes.  Which shard a slot belongs to is data: a versioned map (version, slot,
shards) in Parquet.  Rebalancing aggregates rows and bytes per slot and writes the next
version, an edit of the one before: a shard keeps its largest slots up to its fair share of
the bytes, what is beyond is released, and every released slot goes to the shard that is
least loaded then.  Adding a shard is the same edit with one shard more.

A slot that repeated rows make heavier than a quarter of a shard's fair share is split: its map
row names several shards and its rows are dealt over them in turn.

Only DataFrame functions.  The map has one row a slot, so it may be broadcast and its editing
may run in one task; records are never shuffled to be given a shard.  Positions in a shard
come from windows over (shard, slot) and the sums of the slots before, not from a window over a
shard.

Defined cases: a null text has no bytes and the CRC of none; a null id is hashed as a value like
any other; repeated rows all stay, and which of equal rows has which place is of no consequence;
an empty table gives no rows and an even map; further columns ride along in ``doc``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import staged

SLOTS = 16_384
#: Bytes that a record takes besides its text.
OVERHEAD = 8
#: A slot is split beyond this part of a shard's fair share, into pieces of at least so many rows of its largest size.
SPLIT_PART, PIECE_ROWS = 4, 16
#: Copies of one row that a task makes from one counted row.
COPIES = 4096


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``doc`` (all columns), ``size``, ``text_crc32``, ``virtual_slot`` of every row; nothing is shuffled."""
    text = F.col(f"doc.{text_col}")
    measured = docs.select(F.struct("*").alias("doc")).select(
        "doc",
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    slot = F.pmod(F.xxhash64(F.col(f"doc.{id_col}"), "size", "text_crc32"), F.lit(slots)).cast("int")
    return measured.withColumn("virtual_slot", slot)


def slot_sizes(rows: DataFrame) -> DataFrame:
    """Rows, bytes and largest record of every slot in use: at most one row a slot, pre-aggregated in the tasks."""
    return rows.groupBy(F.col("virtual_slot").alias("slot")).agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes"), F.max("size").alias("largest")
    )


# -- the map ---------------------------------------------------------------


def even_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: equal runs of slots."""
    slot = F.col("id").cast("int")
    return spark.range(slots).select(
        F.lit(1).alias("version"), slot.alias("slot"), F.array(F.floor(F.col("id") * shards / slots).cast("int")).alias("shards")
    )


def store_map(slot_map: DataFrame, path: str) -> None:
    """Add one version to the stored map; the versions before stay."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, by default the newest."""
    stored = spark.read.schema("slot int, shards array<int>, version int").parquet(path)
    newest = stored.agg(F.max("version").alias("v")).select("v").scalar()
    return stored.where(F.col("version") == (newest if version is None else F.lit(version))).select("version", "slot", "shards")


def _pieces(fair: Column, shards: int) -> Column:
    """Into how many pieces a slot is split: one, unless many rows make it heavy."""
    wanted = F.ceil(F.col("bytes") * SPLIT_PART / fair)
    possible = F.floor(F.col("bytes") / (F.col("largest") * PIECE_ROWS))
    pieces = F.greatest(F.lit(1), F.least(F.lit(shards), wanted, possible))
    return F.when(F.col("bytes") * SPLIT_PART > fair, pieces).otherwise(1).cast("int")


def rebalanced(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of ``slot_map`` for ``shards`` shards, given the bytes of the slots.

    Slots stay where they are as long as their shard has no more than its fair share.
    """
    spark = slot_map.sparkSession
    fair = F.coalesce(sizes.agg((F.sum("bytes") / shards).alias("fair")).scalar(), F.lit(0.0))
    old = slot_map.join(sizes, "slot", "left").na.fill(0, ["n", "bytes"]).na.fill(1, ["largest"])
    split = old.withColumn("pieces", _pieces(fair, shards))
    items = split.select(
        "slot",
        (F.col("bytes") / F.col("pieces")).cast("long").alias("bytes"),
        F.posexplode(
            F.when(F.col("pieces") == F.size("shards"), F.col("shards")).otherwise(
                F.concat(F.slice("shards", 1, F.least("pieces", F.size("shards"))), F.array_repeat(F.lit(-1), F.col("pieces") - F.size("shards")))
            )
        ).alias("piece", "shard"),
    )
    heavy_first = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot", "piece")
    running = items.withColumn("held", F.sum("bytes").over(heavy_first.rowsBetween(Window.unboundedPreceding, 0)))
    stays = F.col("shard").between(0, shards - 1) & ((F.col("held") <= fair) | (F.row_number().over(heavy_first) == 1) | (F.col("bytes") == 0))
    judged = running.withColumn("stays", stays).select("slot", "piece", "bytes", "shard", "stays")
    kept = judged.where("stays")

    loads = spark.range(shards).select(F.col("id").cast("int").alias("shard")).join(
        kept.groupBy("shard").agg(F.sum("bytes").alias("load")), "shard", "left"
    )
    start = loads.agg(F.sort_array(F.collect_list(F.struct(F.coalesce("load", F.lit(0)).cast("long").alias("load"), "shard"))).alias("loads"))
    loose = judged.where("NOT stays").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("minus"), "slot", "piece"))).alias("loose")
    )
    # both frames are one row; the fold gives each slot to the shard that is least loaded by then
    one = start.select(F.col("loads"), loose.scalar().alias("loose"))
    folded = one.select(
        "loose",
        F.expr(
            """aggregate(loose,
                 named_struct('loads', loads, 'picks', cast(array() AS array<int>)),
                 (held, item) -> named_struct(
                   'loads', sort_array(concat(
                      array(named_struct('load', held.loads[0].load - item.minus, 'shard', held.loads[0].shard)),
                      slice(held.loads, 2, size(held.loads)))),
                   'picks', concat(held.picks, array(held.loads[0].shard))),
                 held -> held.picks)"""
        ).alias("picks"),
    )
    given = folded.select(F.explode(F.arrays_zip("loose", "picks")).alias("g")).select(
        F.col("g.loose.slot").alias("slot"), F.col("g.loose.piece").alias("piece"), F.col("g.picks").alias("shard")
    )
    version = slot_map.agg((F.max("version") + 1).alias("v")).scalar()
    owners = kept.select("slot", "piece", "shard").unionByName(given).groupBy("slot")
    together = owners.agg(F.array_sort(F.collect_list(F.struct("piece", "shard"))).alias("owners"))
    return together.select(version.cast("int").alias("version"), "slot", F.col("owners.shard").alias("shards"))


# -- using the map -----------------------------------------------------------


def with_shard(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``rows`` of :func:`records` with their ``shard``; the map (one row a slot) is broadcast."""
    owners = slot_map.select(F.col("slot").alias("virtual_slot"), "shards")
    turn = F.pmod(F.monotonically_increasing_id(), F.size("shards").cast("long")).cast("int")
    shard = F.when(F.size("shards") == 1, F.element_at("shards", 1)).otherwise(F.element_at("shards", turn + 1))
    return rows.join(F.broadcast(owners), "virtual_slot").withColumn("shard", shard).drop("shards")


def write_shards(rows: DataFrame, slot_map: DataFrame, path: str, files_a_shard: int = 16) -> None:
    """All columns of the records, one folder a shard, at most ``files_a_shard`` files in each."""
    placed = with_shard(rows, slot_map)
    parted = placed.repartition("shard", F.pmod("virtual_slot", F.lit(files_a_shard)))
    parted.select("doc.*", F.col("shard").alias("_shard")).write.partitionBy("_shard").parquet(path)


def _copies(counted: DataFrame) -> DataFrame:
    """One row for each of the ``m`` copies a row counts, with ``copy`` from 0; many copies are made by many tasks."""
    few = counted.where(F.col("m") <= COPIES).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    parts = counted.where(F.col("m") > COPIES).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / COPIES))))
    dealt = parts.repartition(F.col("part"), F.col("text_crc32"))
    last = F.least(F.col("m"), (F.col("part") + 1) * COPIES) - 1
    return few.unionByName(dealt.withColumn("copy", F.explode(F.sequence(F.col("part") * COPIES, last))).drop("part"))


def positions(placed: DataFrame, *key: str) -> DataFrame:
    """``placed`` (columns ``key``, virtual_slot, shard) with ``slot``: its place in its shard, from 0 without gaps.

    Slots follow each other in a shard; in a slot rows go by ``key``.  Equal rows are counted
    before they are shuffled.
    """
    counted = placed.groupBy(*key, "virtual_slot", "shard").agg(F.count("*").alias("m"))
    in_slot = Window.partitionBy("shard", "virtual_slot").orderBy(*key)
    before = counted.withColumn("before", F.sum("m").over(in_slot.rowsBetween(Window.unboundedPreceding, 0)) - F.col("m"))
    held = placed.groupBy("shard", "virtual_slot").agg(F.count("*").alias("held"))
    in_shard = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    starts = held.select("shard", "virtual_slot", (F.sum("held").over(in_shard) - F.col("held")).alias("starts"))
    # one row for each slot of the map and piece of a split slot
    spread = _copies(before.join(F.broadcast(starts), ["shard", "virtual_slot"]))
    return spread.withColumn("slot", F.col("starts") + F.col("before") + F.col("copy")).drop("m", "before", "starts", "copy")


def shard_documents(docs: DataFrame, shards: int, map_path: str, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """id, size, text_crc32, virtual_slot, shard, map_version, slot of every document.

    The map is stored at ``map_path``: version 1 deals the slots evenly, version 2 is its
    edit by the bytes found.  A map that is there already is edited further.
    """
    spark = docs.sparkSession
    rows = records(docs, id_col, text_col, slots).select(F.col(f"doc.{id_col}").alias("id"), "size", "text_crc32", "virtual_slot")
    rows = staged(rows, "shard-records")
    slot_map = latest_map(spark, map_path, shards, slots)
    store_map(rebalanced(slot_map, slot_sizes(rows), shards), map_path)
    current = read_map(spark, map_path)
    version = current.agg(F.max("version").alias("v")).scalar()
    # the turn of a split slot's rows is fixed by writing it
    placed = staged(with_shard(rows, current), "shard-placed")
    return positions(placed, "id", "size", "text_crc32").withColumn("map_version", version)


def latest_map(spark: SparkSession, path: str, shards: int, slots: int = SLOTS) -> DataFrame:
    """The newest version stored at ``path``; version 1 is written first if there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        store_map(even_map(spark, shards, slots), path)
    return read_map(spark, path)
