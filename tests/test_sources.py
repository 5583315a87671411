"""Readers and drop-file handling (S4-S8; H8-H10, H30)."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fraudmart.operators.files import MissingFeedError, oldest_drop, require_feeds, unseen_files
from fraudmart.sources.listing import list_drop_files
from fraudmart.sources.tables import read_source
from fraudmart.sources.text import read_transactions
from fraudmart.sources.xlsx import read_blacklist, read_terminals
from xlsx_writer import write_xlsx

D = dt.datetime


def test_transactions_csv_positional_with_decimal_comma(spark, workdir):
    path = os.path.join(workdir, "transactions_01012021.txt")
    with open(path, "w", encoding="utf-8") as f:
        # header names are deliberately misleading: binding is by position
        f.write("card;amount;date;id;x;y;z\n")
        f.write("1;2021-01-01 10:00:00;2,45;C1;PAY;OK;T1\n")
        f.write("2;2021-01-01 11:00:00;100.10;C2;;REJECT;T2\n")
    rows = read_transactions(spark, path).orderBy("trans_id").collect()
    assert rows[0].trans_id == "1" and rows[0].card_num == "C1"
    assert rows[0].amt == Decimal("2.45")  # H9
    assert rows[0].trans_date == D(2021, 1, 1, 10)
    assert rows[1].oper_type is None  # empty cell is NULL (H3)


def test_malformed_date_fails(spark, workdir):
    path = os.path.join(workdir, "bad.txt")
    with open(path, "w") as f:
        f.write("a;b;c;d;e;f;g\n1;01/01/2021;1;C;P;O;T\n")
    with pytest.raises(Exception):
        read_transactions(spark, path).collect()


def test_workbooks(spark, workdir):
    term = write_xlsx(
        os.path.join(workdir, "terminals_01012021.xlsx"),
        [["id", "type", "city", "address"], ["T1", "ATM", "Moscow", "Street 1"], [42, "POS", None, "x"]],
    )
    rows = read_terminals(spark, term).orderBy("terminal_id").collect()
    assert [tuple(r) for r in rows] == [("42", "POS", None, "x"), ("T1", "ATM", "Moscow", "Street 1")]
    bl = write_xlsx(
        os.path.join(workdir, "passport_blacklist_01012021.xlsx"),
        [["date", "passport"], [D(2021, 1, 1, 12, 30), "1234 567890"], [D(2020, 2, 29), 5555]],
    )
    rows = read_blacklist(spark, bl).orderBy("entry_dt").collect()
    assert [tuple(r) for r in rows] == [(D(2020, 2, 29), "5555"), (D(2021, 1, 1, 12, 30), "1234 567890")]


def test_many_workbooks(spark, workdir):
    paths = [
        write_xlsx(os.path.join(workdir, f"terminals_0{i}012021.xlsx"), [["h"] * 4, [f"T{i}", "ATM", "c", "a"]])
        for i in range(1, 4)
    ]
    df = read_terminals(spark, paths)
    assert sorted(r.terminal_id for r in df.collect()) == ["T1", "T2", "T3"]


def _files(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_oldest_drop_per_feed(spark):
    names = [
        "transactions_03012021.txt",
        "transactions_01022020.txt",
        "terminals_b_05012021.xlsx",
        "terminals_05012021.xlsx",
        "passport_blacklist_02012021.xlsx",
        "readme.md",  # belongs to no feed: ignored, never parsed
    ]
    got = {r.feed: (r.name, r.drop_date) for r in oldest_drop(_files(spark, names)).collect()}
    assert got["transactions"] == ("transactions_01022020.txt", dt.date(2020, 2, 1))
    assert got["terminals"][0] == "terminals_05012021.xlsx"  # H30: tie broken by name
    assert got["passport_blacklist"][1] == dt.date(2021, 1, 2)


def test_name_without_stamp_fails(spark):
    with pytest.raises(Exception, match="no ddMMyyyy stamp"):
        oldest_drop(_files(spark, ["transactions_latest.txt"])).collect()  # H8


def test_missing_feed_fails(spark):
    drops = oldest_drop(_files(spark, ["transactions_01012021.txt"]))
    with pytest.raises(MissingFeedError, match="terminals"):
        require_feeds(drops)


def test_unseen_and_listing(spark, workdir):
    for n in ("transactions_01012021.txt", "transactions_02012021.txt"):
        open(os.path.join(workdir, n), "w").write("x")
    listing = list_drop_files(spark, workdir)
    ledger = _files(spark, ["transactions_01012021.txt"])
    assert [r.name for r in unseen_files(listing, ledger).collect()] == ["transactions_02012021.txt"]


def test_read_source_conforms(spark, workdir):
    path = os.path.join(workdir, "accounts")
    spark.createDataFrame(
        [("1", D(2022, 1, 1), "", D(2020, 1, 1), None)],
        "account string, valid_to timestamp_ntz, client string, create_dt timestamp_ntz, update_dt timestamp_ntz",
    ).write.parquet(path)
    df = read_source(spark, "accounts", path)
    assert df.columns == ["account_num", "valid_to", "client", "create_dt", "update_dt"]
    assert df.collect()[0].client is None  # empty text -> NULL
    assert df.where(F.col("account_num") == "1").count() == 1


def test_quotes_and_separators_in_a_field(spark, workdir):
    path = os.path.join(workdir, "transactions_01012021.txt")
    with open(path, "w") as f:
        f.write('a;b;c;d;e;f;g\n1;2021-01-01 10:00:00;1;C1;"say ""hi"";";OK;T1\n')
    assert read_transactions(spark, path).first().oper_type == 'say "hi";'


@pytest.mark.parametrize("row", ["1;2021-13-01 10:00:00;1;C;P;O;T", "1;2021-01-01 10:00:00;1,234.56;C;P;O;T"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unreadable_values_fail(spark, workdir, row, ansi):
    path = os.path.join(workdir, "bad.txt")
    with open(path, "w") as f:
        f.write(f"a;b;c;d;e;f;g\n{row}\n")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception):
            read_transactions(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_workbook_rows_are_never_dropped(spark, workdir):
    head = ["id", "type", "city", "address"]
    wide = write_xlsx(os.path.join(workdir, "terminals_01012021.xlsx"), [head, ["T1", "ATM", "c", "a", "more"]])
    with pytest.raises(Exception, match="more than 4 columns"):
        read_terminals(spark, wide).collect()
    blank = write_xlsx(os.path.join(workdir, "terminals_02012021.xlsx"), [head, ["T1", "ATM", "c", "a"], [None] * 4, ["T2", "ATM", "c", "a"], [None] * 4])
    assert [r.terminal_id for r in read_terminals(spark, blank).collect()] == ["T1", None, "T2"]
    late = write_xlsx(os.path.join(workdir, "passport_blacklist_01012021.xlsx"), [["d", "p"], ["2021-03-01 10:00:00 garbage", "P"]])
    with pytest.raises(Exception):
        read_blacklist(spark, late).collect()


def test_corrected_file_is_new(spark, workdir):
    name = os.path.join(workdir, "transactions_01012021.txt")
    open(name, "w").write("x")
    ledger = list_drop_files(spark, workdir).select("name", "length", "modified")
    ledger = spark.createDataFrame(ledger.collect(), ledger.schema)
    assert unseen_files(list_drop_files(spark, workdir), ledger).count() == 0
    open(name, "w").write("xy")
    assert unseen_files(list_drop_files(spark, workdir), ledger).count() == 1


def test_jdbc_options():
    from fraudmart.__main__ import _jdbc
    from fraudmart.sources.tables import JdbcSource

    args = type("A", (), {"jdbc_url": "jdbc:x:y", "jdbc_prop": ["user=me", "password=a=b"], "jdbc_partitions": 8})
    got = _jdbc(args, "BANK.CARDS,ID,1,900").options()
    assert got["dbtable"] == "BANK.CARDS" and got["partitionColumn"] == "ID" and got["numPartitions"] == "8"
    assert got["lowerBound"] == "1" and got["upperBound"] == "900" and got["preferTimestampNTZ"] == "true"
    assert got["user"] == "me" and got["password"] == "a=b"
    with pytest.raises(ValueError, match="bounds"):
        JdbcSource("u", "t", "", "", "").options()
    with pytest.raises(SystemExit):
        _jdbc(args, "BANK.CARDS")
