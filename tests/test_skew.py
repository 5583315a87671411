"""A hot card holding a third of all transactions (derived from the fixture):
AQE splits its join partition, and the report stays whole and exact."""

import contextlib

from pyspark.sql import functions as F

from fraudmart import oracle_sql
from fraudmart.fixtures import AS_OF, Fixture
from fraudmart.operators.report import fraud_report
from oracle_compare import _rows, duckdb_connection
from plan_text import plan_text

SF = "/root/testdata/sf0.01"
HOT = "C1"  # an existing card

SKEW_CONF = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",  # force shuffle joins
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_card_is_split_and_result_exact(spark):
    fx = Fixture(spark, SF)
    tx = fx.transactions.withColumn(
        "card_num",
        F.when(F.split("trans_id", "-").getItem(0).cast("long") % 3 == 0, F.lit(HOT)).otherwise(F.col("card_num")),
    )
    hot_share = tx.where(F.col("card_num") == HOT).count() / tx.count()
    assert hot_share > 0.3
    # AQE splits a skewed partition along map outputs; the sf0.01 file is read by
    # one task, so spread it over several input tasks as a cluster scan would be.
    tx = tx.repartition(8)
    with conf(spark, SKEW_CONF):
        df = fraud_report(fx.clients, fx.accounts, fx.cards, tx, fx.blacklist, AS_OF)
        got = _rows(df.columns, [tuple(r) for r in df.collect()])
        final = plan_text(df, "simple")
    assert "skew=true" in final

    # DuckDB on the same derivation: the whole result, row for row
    views = dict(oracle_sql.VIEWS)
    views["transactions"] = (
        "SELECT trans_id, trans_date, CASE WHEN CAST(split_part(trans_id, '-', 1) AS BIGINT) % 3 = 0 "
        f"THEN '{HOT}' ELSE card_num END card_num, oper_type, amt, oper_result, terminal FROM ("
        + oracle_sql.VIEWS["transactions"] + ")"
    )
    old = oracle_sql.VIEWS
    try:
        oracle_sql.VIEWS = views
        sql = oracle_sql.with_views(oracle_sql.STATEMENTS["fraud_report"])
    finally:
        oracle_sql.VIEWS = old
    cur = duckdb_connection(SF).execute(sql)
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    assert got == want and len(got) > 10000
