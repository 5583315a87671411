"""Change capture and watermarks (C1-C6, C17, C18, C24; H19-H22, H24)."""

import datetime as dt


from fraudmart.operators.capture import (
    capture_accounts,
    capture_changed,
    capture_terminals,
    capture_transactions,
    source_keys,
)
from fraudmart.operators.watermarks import (
    advance_watermarks,
    seed_watermarks,
    watermark_column,
    watermark_value,
    watermark_values,
)
from plan_text import plan_text

SRC = "id string, create_dt timestamp_ntz, update_dt timestamp_ntz"
D = dt.datetime


def _src(spark):
    return spark.createDataFrame(
        [
            ("a", D(2020, 1, 1), None),  # before
            ("b", D(2020, 1, 1), D(2020, 6, 1)),  # updated after
            ("c", D(2020, 3, 1), None),  # exactly at the mark: never captured (H20)
            ("d", None, None),  # no stamp: never captured (H21)
            ("e", D(2020, 4, 1), None),
        ],
        SRC,
    )


def test_capture_strictly_newer(spark):
    got = sorted(r.id for r in capture_changed(_src(spark), "2020-03-01").collect())
    assert got == ["b", "e"]


def test_missing_watermark_captures_nothing(spark):
    control = seed_watermarks(spark, tables=("other",))
    assert watermark_value(control, "dim_clients") is None
    assert capture_changed(_src(spark), None).count() == 0  # H19
    assert capture_changed(_src(spark), watermark_column(control, "dim_clients")).count() == 0


def test_literal_watermark_reaches_scan(spark, workdir):
    path = f"{workdir}/src"
    _src(spark).write.parquet(path)
    plan = plan_text(capture_changed(spark.read.parquet(path), "2020-03-01"), "formatted")
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line][0]
    assert "Or(GreaterThan(update_dt" in pushed and "GreaterThan(create_dt" in pushed


def test_accounts_rename(spark):
    src = spark.createDataFrame(
        [("1", D(2022, 1, 1), "c1", D(2020, 1, 1), None)],
        "account string, valid_to timestamp_ntz, client string, create_dt timestamp_ntz, update_dt timestamp_ntz",
    )
    out = capture_accounts(src, "1900-01-01")
    assert out.columns == ["account_num", "valid_to", "client", "create_dt", "update_dt"]
    assert [r.id for r in source_keys(src, "account_num").collect()] == ["1"]


def test_file_gate_and_stamp(spark):
    feed = spark.createDataFrame([("t1", "ATM", "X", "Y")], "terminal_id string, terminal_type string, "
                                 "terminal_city string, terminal_address string")
    out = capture_terminals(feed, "2021-01-01 10:00:00", "2020-01-01").collect()
    assert out[0].create_dt == D(2021, 1, 1, 10) and out[0].update_dt is None
    # Load time not after the mark -> nothing staged
    assert capture_terminals(feed, "2021-01-01", "2021-01-01").count() == 0


def test_transactions_reordered_and_typed(spark):
    feed = spark.createDataFrame(
        [("7", D(2021, 1, 1, 1, 2, 3), "12.50", "card", "PAY", "OK", "T1")],
        "trans_id string, trans_date timestamp_ntz, amt string, card_num string, oper_type string, "
        "oper_result string, terminal string",
    )
    out = capture_transactions(feed, "2021-01-02", None)
    assert out.count() == 0  # no watermark row -> no capture
    out = capture_transactions(feed, "2021-01-02", "1900-01-01")
    assert out.columns == ["trans_id", "trans_date", "card_num", "oper_type", "amt", "oper_result", "terminal",
                           "create_dt"]
    assert dict(out.dtypes)["amt"] == "decimal(18,2)"


def test_seed_and_advance(spark):
    control = seed_watermarks(spark)
    assert control.count() == 6
    assert {r.last_update for r in control.collect()} == {D(1900, 1, 1)}
    stg_dim = spark.createDataFrame([("x", D(2020, 1, 1), D(2020, 2, 1)), ("y", D(2020, 3, 1), None)], SRC)
    stg_fact = spark.createDataFrame([(D(2021, 1, 1),)], "create_dt timestamp_ntz")
    empty = spark.createDataFrame([], SRC)
    out = {
        r.table_name: r.last_update
        for r in advance_watermarks(
            control, {"dim_clients": stg_dim, "fact_transactions": stg_fact, "dim_cards": empty}
        ).collect()
    }
    assert out["dim_clients"] == D(2020, 3, 1)  # MAX(COALESCE(update, create))
    assert out["fact_transactions"] == D(2021, 1, 1)  # MAX(create_dt)
    assert out["dim_cards"] == D(1900, 1, 1)  # H22: empty staging keeps the mark
    assert out["dim_terminals"] == D(1900, 1, 1)


def test_watermark_values_in_one_collect(spark):
    control = seed_watermarks(spark, tables=("a", "b"))
    assert watermark_values(control) == {"a": "1900-01-01 00:00:00", "b": "1900-01-01 00:00:00"}
    import pytest

    with pytest.raises(ValueError, match="several"):
        watermark_values(control.unionByName(control))


def test_advance_leaves_other_databases(spark):
    control = seed_watermarks(spark, ("dim_cards",)).union(seed_watermarks(spark, ("dim_cards",), db_name="other"))
    staged = spark.createDataFrame([("2021-01-01 00:00:00",)], "c string").selectExpr("CAST(c AS TIMESTAMP_NTZ) create_dt")
    got = {(r.db_name, str(r.last_update)) for r in advance_watermarks(control, {"dim_cards": staged}).collect()}
    assert got == {("dwh", "2021-01-01 00:00:00"), ("other", "1900-01-01 00:00:00")}
