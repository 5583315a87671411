"""Scalar semantics kept from the reference."""

import datetime as dt
from decimal import Decimal

import pytest

from fraudmart.functions import (
    as_ntz,
    change_time,
    check_max_length,
    current_second,
    empty_as_null,
    full_name,
    ntz_literal,
    parse_amount,
    parse_oracle_timestamp,
    to_stamp_text,
)


def test_full_name_skips_nulls_like_oracle(spark):
    df = spark.createDataFrame(
        [("A", "B", None), ("A", None, "C"), (None, None, None), ("A", "B", "C")], "l string, f string, p string"
    )
    got = [r[0] for r in df.select(full_name("l", "f", "p")).collect()]
    assert got == ["A B ", "A  C", "  ", "A B C"]  # H2: trailing space kept, never NULL


def test_empty_string_is_null(spark):
    df = spark.createDataFrame([("",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(empty_as_null("s")).collect()] == [None, "x", None]  # H3


def test_change_time_prefers_update(spark):
    df = spark.createDataFrame([(1,)], "x int").select(
        change_time(as_ntz("2020-01-02"), as_ntz("2020-01-01")).alias("a"),
        change_time(as_ntz(None), as_ntz("2020-01-01")).alias("b"),
        change_time(as_ntz(None), as_ntz(None)).alias("c"),
    )
    r = df.collect()[0]
    assert r.a == dt.datetime(2020, 1, 2) and r.b == dt.datetime(2020, 1, 1) and r.c is None


def test_oracle_timestamp_keeps_time(spark):
    df = spark.createDataFrame([("2021-03-01 10:11:12",)], "s string")
    r = df.select(parse_oracle_timestamp("s").alias("t")).collect()[0]
    assert r.t == dt.datetime(2021, 3, 1, 10, 11, 12)
    assert dict(df.select(parse_oracle_timestamp("s").alias("t")).dtypes)["t"] == "timestamp_ntz"


def test_amount_accepts_decimal_comma_and_rounds_half_up(spark):
    df = spark.createDataFrame([("2,45",), ("1234.565",), (" 10 ",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_amount("s")).collect()]
    assert got == [Decimal("2.45"), Decimal("1234.57"), Decimal("10.00"), None, None]  # H9


def test_strict_compare_on_midnight(spark):
    # H6: a document valid to midnight is expired from 00:00:01 of that day
    df = spark.createDataFrame([(1,)], "x int").select(
        (ntz_literal("2021-05-01") < ntz_literal("2021-05-01 00:00:01")).alias("expired"),
        (ntz_literal("2021-05-01") < ntz_literal("2021-05-01 00:00:00")).alias("same"),
    )
    r = df.collect()[0]
    assert r.expired is True and r.same is False


def test_check_max_length_raises(spark):
    ok = spark.createDataFrame([("abc",)], "s string").select(check_max_length("s", 3, "fio")).collect()
    assert ok[0][0] == "abc"
    with pytest.raises(Exception, match="longer than 3"):
        spark.createDataFrame([("abcd",)], "s string").select(check_max_length("s", 3, "fio")).collect()  # H4


def test_stamps(spark):
    assert to_stamp_text("2001-01-01") == "2001-01-01 00:00:00"
    assert to_stamp_text(dt.datetime(2001, 1, 1, 5, 6, 7, 890)) == "2001-01-01 05:06:07"
    r = spark.range(1).select(current_second().alias("t")).collect()[0]
    assert r.t.microsecond == 0
    assert dict(spark.range(1).select(current_second().alias("t")).dtypes)["t"] == "timestamp_ntz"


def test_enforce_varchar(spark):
    from fraudmart.functions import enforce_varchar

    df = spark.createDataFrame([("a" * 100, 1)], "s string, n int")
    assert enforce_varchar(df, 100).collect()[0].s == "a" * 100
    with pytest.raises(Exception, match="longer than 100"):
        enforce_varchar(spark.createDataFrame([("é" * 101, 1)], "s string, n int"), 100).collect()
