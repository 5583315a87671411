import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, score string, doc string, node int, comp string, kept int"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, copies, repeated rows, a null id; further columns with names of outputs."""
    long = " ".join(f"word{k * 7919 % 100_003} of the long text" for k in range(90_000))
    copy = "the quick brown fox jumps over the lazy dog and runs far away into the deep dark forest before the night falls upon the hills again"
    texts = [None, "", " \n\t ", "a", "a b", "x\ny\nz", copy, copy, copy.upper() + " ", "été Ünïcode 中文字 x" * 9, " \xa0\x00 odd", "....", long]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("s1", "s2", None)[i % 3], 0, "s", "d", 1, "c", 0) for i, t in enumerate(texts)]
    return [*rows, rows[6], (None, copy, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
