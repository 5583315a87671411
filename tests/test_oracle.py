"""Every driver query against its DuckDB oracle on the smallest fixture."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duckdb_connection
from paths import SF_SMALL

from fraudmart.queries import QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    con = duckdb_connection(SF_SMALL)
    assert df.count() == con.execute(f"SELECT count(*) FROM ({entry.oracle_sql()['fraud_report']})").fetchone()[0] > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name])[name]
    assert "error" not in res, res
    assert res["columns_match"] and res["values_match"], res
