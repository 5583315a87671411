"""SCD1 upsert and delete (D3, D4) with NULL-key rules H15-H18, plus laws."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plan_text import plan_text

from fraudmart.operators.scd1 import (
    DuplicateKeyError,
    assert_unique_keys,
    missing_keys,
    scd1_apply,
    scd1_delete,
    scd1_upsert,
)

SCHEMA = "k string, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))


def test_upsert_updates_matched_inserts_new(spark):
    t = spark.createDataFrame([("1", "a"), ("2", "b")], SCHEMA)
    s = spark.createDataFrame([("2", "B"), ("3", "c")], SCHEMA)
    assert rows(scd1_upsert(t, s, "k")) == [("1", "a"), ("2", "B"), ("3", "c")]


def test_upsert_null_keys_insert_again(spark):
    # NULL never matches, so a NULL-key staging row is inserted each time
    t = spark.createDataFrame([(None, "old")], SCHEMA)
    s = spark.createDataFrame([(None, "new")], SCHEMA)
    once = scd1_upsert(t, s, "k")
    assert rows(once) == [(None, "new"), (None, "old")]
    assert len(rows(scd1_upsert(once, s, "k"))) == 3


def test_duplicate_staging_keys_raise(spark):
    s = spark.createDataFrame([("1", "a"), ("1", "b"), (None, "x"), (None, "y")], SCHEMA)
    with pytest.raises(DuplicateKeyError, match="'1'"):
        assert_unique_keys(s, "k")  # H15
    assert_unique_keys(s.where("k IS NULL"), "k")  # NULL keys exempt


def test_delete_keeps_null_keys_and_present_keys(spark):
    t = spark.createDataFrame([("1", "a"), ("2", "b"), (None, "n")], SCHEMA)
    src = spark.createDataFrame([("1",), ("1",), (None,)], "id string")
    assert rows(scd1_delete(t, src, "k")) == [("1", "a"), (None, "n")]  # H17, no duplicates
    assert rows(missing_keys(t, src, "k")) == [("2",), (None,)]


def test_empty_source_deletes_all_non_null(spark):
    t = spark.createDataFrame([("1", "a"), (None, "n")], SCHEMA)
    src = spark.createDataFrame([], "id string")
    assert rows(scd1_delete(t, src, "k")) == [(None, "n")]  # H18


def test_plans_use_one_join_each(spark):
    t = spark.createDataFrame([("1", "a")], SCHEMA)
    s = spark.createDataFrame([("2", "b")], SCHEMA)
    up = plan_text(scd1_upsert(t, s, "k"))
    de = plan_text(scd1_delete(t, s.selectExpr("k id"), "k"))
    assert "FullOuter" in up and up.count("SortMergeJoin") == 1
    assert "LeftSemi" in de and "LeftOuter" not in de


def test_merge_moves_a_key_once(spark):
    """The columns themselves are shuffled, not the key and a struct that repeats it."""
    target, staging = spark.createDataFrame([("1", "a"), (None, "n")], SCHEMA), spark.createDataFrame([("1", None), ("2", "b")], SCHEMA)
    got = scd1_upsert(target, staging, "k")
    assert rows(got) == rows(spark.createDataFrame([("1", None), ("2", "b"), (None, "n")], SCHEMA))
    assert "struct" not in plan_text(got)


keys = st.one_of(st.none(), st.sampled_from([str(i) for i in range(8)]))
vals = st.sampled_from(["a", "b", "c"])


def _unique(pairs):
    seen, out = set(), []
    for k, v in pairs:
        if k is None or k not in seen:
            out.append((k, v))
            if k is not None:
                seen.add(k)
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(keys, vals), max_size=8), st.lists(st.tuples(keys, vals), max_size=8))
def test_upsert_matches_reference_merge(spark, target, staging):
    target, staging = _unique(target), _unique(staging)
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(staging, SCHEMA)
    got = rows(scd1_upsert(t, s, "k"))
    # reference MERGE by hand: update matched non-NULL keys, insert the rest
    staged = {k: v for k, v in staging if k is not None}
    expect = [(k, staged.get(k, v)) if k is not None else (k, v) for k, v in target]
    tkeys = {k for k, _ in target if k is not None}
    expect += [(k, v) for k, v in staging if k is None or k not in tkeys]
    assert got == sorted(expect, key=lambda t: tuple((x is None, x) for x in t))
    # law: upsert is idempotent for non-NULL keys
    s_keyed = s.where("k IS NOT NULL")
    once = scd1_upsert(t, s_keyed, "k")
    assert rows(scd1_upsert(once, s_keyed, "k")) == rows(once)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(keys, vals), max_size=8), st.lists(keys, max_size=8))
def test_delete_law(spark, target, source):
    t = spark.createDataFrame(target, SCHEMA)
    src = spark.createDataFrame([(k,) for k in source], "id string")
    got = rows(scd1_delete(t, src, "k"))
    present = {k for k in source if k is not None}
    expect = [(k, v) for k, v in target if k is None or k in present]
    assert got == sorted(expect, key=lambda t: tuple((x is None, x) for x in t))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(keys, vals), max_size=8),
    st.lists(st.tuples(keys, vals), max_size=8),
    st.lists(keys, max_size=8),
)
def test_apply_equals_upsert_then_delete(spark, target, staging, source):
    t = spark.createDataFrame(_unique(target), SCHEMA)
    s = spark.createDataFrame(_unique(staging), SCHEMA)
    src = spark.createDataFrame([(k,) for k in source], "id string")
    assert rows(scd1_apply(t, s, src, "k")) == rows(scd1_delete(scd1_upsert(t, s, "k"), src, "k"))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(keys, vals), max_size=8), st.lists(st.tuples(keys, vals), max_size=6))
def test_duplicate_target_rows_match_merge(spark, target, staging):
    """A key that the target has twice: both rows are updated, as MERGE does."""
    import duckdb

    staging = _unique(staging)
    con = duckdb.connect()
    for name, data in (("t", target), ("s", staging)):
        con.execute(f"CREATE TABLE {name} (k VARCHAR, v VARCHAR)")
        if data:
            con.executemany(f"INSERT INTO {name} VALUES (?, ?)", data)
    con.execute("UPDATE t SET v = s.v FROM s WHERE t.k = s.k")
    con.execute("INSERT INTO t SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t d WHERE d.k = s.k)")
    expect = con.execute("SELECT * FROM t").fetchall()
    got = rows(scd1_upsert(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(staging, SCHEMA), "k"))
    assert got == sorted(expect, key=lambda t: tuple((x is None, x) for x in t))
