"""The corpus pipeline: raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a frame, which is written and read again as the next one's docs.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.llm import decontamination, line_dedup, near_dedup, packing, quality
from fraudmart.llm.common import staged, table
from fraudmart.llm.queries import tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, scores 0.5 or more; empty ones go."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("score >= 0.5").select("doc.*")


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many sites share (the first occurrence stays); one left with no line goes."""
    cleaned = line_dedup.remove_boilerplate(docs).where("NOT emptied")
    changed = {"text": F.col("cleaned"), "n_chars": F.when(F.col("n_removed") > 0, F.length("cleaned")).otherwise(F.col("doc.n_chars"))}
    return cleaned.select(*(changed[c].cast(kind).alias(c) if c in changed else F.col(f"doc.{c}") for c, kind in docs.dtypes))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.keep_first(docs, size=5, percent=80)


def not_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select("doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids, with their ids."""
    return packing.pack_documents(docs, tokenizer_path()).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("line dedup", own_lines),
    ("near-dedup", one_of_each),
    ("decontamination", not_leaked),
    ("packing", packed),
]

#: A trained classifier is no SQL; tests hold every stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, one after another."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"), "snappy")
    return docs
