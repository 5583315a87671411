"""Line dedup: boilerplate lines found by their spread over distinct sites.

A line (trimmed, not blank) that stands on at least ``min_sites`` sites is
boilerplate: it stays where it occurs first (smallest id, then line) and is
removed everywhere else.  Spread is measured with HyperLogLog sketches per line
hash, merged by aggregation; a line whose estimate is near the threshold gets an
exact distinct count.  Only lines of two sites or more have sketches at all:
the least and greatest site of a line tell, in one aggregation that collapses hot
lines before the shuffle.  Lines are told apart by 128 bits of hash.

Defined cases: a null text has no lines and stays null; a null site counts for no
line; documents with a null id count for spread but are left as they are; rows of
one id are one document, each rewritten; an empty table gives no rows; input columns
stay in ``doc``, so names can't clash.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import staged

MIN_SITES = 10
#: log2 of a sketch's registers, and the standard errors around the threshold that are counted exactly.
LOG_REGISTERS, ERRORS = 10, 4
BLANK = " \t\r"


def line_rows(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """(id, site, at, a, b): every line that is not blank, by place and hashes."""
    lines = docs.select(
        F.col(id_col).alias("id"), F.col(site_col).cast("string").alias("site"), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("at", "line")
    ).withColumn("line", F.btrim("line", F.lit(BLANK)))
    return lines.where("line <> ''").select("id", "site", "at", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))


def boilerplate(lines: DataFrame, min_sites: int, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """(a, b, first) of the lines on at least ``min_sites`` sites; ``first`` is (id, at)."""
    sketches = lines.groupBy("a", "b").agg(
        F.hll_sketch_agg("site", F.lit(log_registers)).alias("sketch"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "at"))).alias("first")
    )
    measured = staged(sketches.select("a", "b", "first", F.hll_sketch_estimate("sketch").alias("sites")), "line-spread")
    margin = max(1, math.ceil(ERRORS * 1.04 / math.sqrt(1 << log_registers) * min_sites))
    sure = measured.where(F.col("sites") > min_sites + margin)
    near = measured.where(F.col("sites").between(min_sites - margin, min_sites + margin))
    exact = lines.join(near.select("a", "b"), ["a", "b"], "left_semi").groupBy("a", "b").agg(F.count_distinct("site").alias("n"))
    return sure.select("a", "b", "first").union(near.join(exact.where(F.col("n") >= min_sites), ["a", "b"]).select("a", "b", "first"))


def remove_boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
) -> DataFrame:
    """Each row of ``docs`` as ``doc``, with ``cleaned`` text, n_lines, n_removed and ``emptied`` (nothing but blanks left)."""
    lines = line_rows(docs, id_col, text_col, site_col)
    site_hash = F.when(F.col("site").isNotNull(), F.xxhash64("site"))  # numbers aggregate by hash, texts by sorting
    shared = lines.groupBy("a", "b").agg(F.min(site_hash).alias("least"), F.max(site_hash).alias("most")).where("least <> most")
    shared = staged(shared.select("a", "b"), "shared-lines")  # read back, so that a hot line's rows can be split in the join
    spread = staged(lines.join(shared, ["a", "b"], "left_semi"), "lines-of-sites")
    repeated = spread.join(boilerplate(spread, min_sites), ["a", "b"]).where(F.struct("id", "at") != F.col("first"))
    gone = repeated.groupBy("id").agg(F.collect_set("at").alias("gone"))
    rows = docs.select(F.struct("*").alias("doc"))
    text = F.col("doc").getField(text_col)
    rows = rows.join(gone, F.col("doc").getField(id_col) == F.col("id"), "left").select("doc", "gone", F.split(text, "\n", -1).alias("lines"))
    kept = F.filter("lines", lambda line, at: ~F.array_contains("gone", at))
    rows = rows.select("doc", "gone", "lines", F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("cleaned"))
    n_removed = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    return rows.select(
        "doc",
        "cleaned",
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0).cast("long")).otherwise(n_removed).alias("n_removed"),
        (F.col("gone").isNotNull() & (F.btrim("cleaned", F.lit(BLANK + "\n")) == "")).alias("emptied"),
    )
