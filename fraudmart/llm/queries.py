"""The driver's queries over this subpackage: each applies its operator to the whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.llm import (
    ann,
    decontamination,
    hard_negatives,
    language_id,
    line_dedup,
    lm_scoring,
    merkle,
    near_dedup,
    packing,
    quality,
    sharding,
    suffix_dedup,
    url_filter,
)
from fraudmart.llm.common import crc_remainder, table
from fraudmart.session import scratch_path


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a trigram model of six sevenths of them."""
    held_out = crc_remainder(F.col("doc_id"), 7) == 2
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"), held_out, order=3).withColumnRenamed("id", "doc_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without boilerplate lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    cleaned = line_dedup.remove_boilerplate(docs)
    return cleaned.select("doc.doc_id", "n_lines", "n_removed", F.sha2("cleaned", 256).alias("kept_sha256"))


def tokenizer_path() -> str:
    """The public tokenizer of the packing query; a file outside the repository."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences."""
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document linked by similar sets of three-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_components(docs, size=3, percent=85).withColumnRenamed("id", "doc_id")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels of two thirds of the ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels").where(crc_remainder(F.col("doc_id"), 3) != 1))
    scored = quality.score(docs, model)
    return scored.select(
        "doc.doc_id",
        (crc_remainder(F.col("doc.doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 100 bytes that start earlier too."""
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        "doc.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from two thirds of the rows."""
    held_out = crc_remainder(F.col("doc_id"), 3) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    prototypes = language_id.learn(docs.where(~held_out))
    found = language_id.predict(docs.select("doc_id", "text"), prototypes)
    return found.select("doc.doc_id", (crc_remainder(F.col("doc.doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proof of every document, and whether a copy with a changed count of characters passes it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = merkle.leaf_hash(*(F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields))
    made = merkle.manifest(docs, fields, "doc_id", "lang", F.when(crc_remainder(F.col("doc_id"), 7) == 0, tampered))
    held = made.withColumn("held", F.coalesce("claim", "leaf"))
    siblings = F.array_join(F.transform("steps", lambda s: s.hash), "")
    return held.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        merkle.fold("held", "steps").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the nearest positives of every vector whose id is divisible by 50."""
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, changed)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document, by the bytes of its virtual slot."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.shard_documents(docs, 24, scratch_path(spark, "llm", f"slot-map-{uuid.uuid4().hex}"))
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_near_dedup": op4_near_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_language_id": op8_language_id,
    "op9_nearest": op9_nearest,
    "op10_url_filters": op10_url_filters,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_sharding": op13_sharding,
}
