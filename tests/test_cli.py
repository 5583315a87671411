"""The command line runs init, daily and show against parquet sources."""

import os

from fraudmart.__main__ import main
from test_daily import _drop, _sources


def test_cli_init_daily_show(spark, workdir, capsys):
    src = {}
    for name, df in _sources(spark, ["1", "2"]).items():
        path = os.path.join(workdir, name)
        (df.withColumnRenamed("account_num", "account") if name in ("accounts", "cards") else df).write.parquet(path)
        src[name] = path
    wh, drops = os.path.join(workdir, "wh"), os.path.join(workdir, "drops")
    _drop(drops, 1, [("1", "2021-01-01 09:00:00", "1", "K1", "PAY", "OK", "T1")])
    common = ["--warehouse", wh, "--clients", src["clients"], "--accounts", src["accounts"], "--cards", src["cards"]]
    assert main(["init", *common]) == 0
    assert main(["daily", *common, "--drops", drops, "--load-ts", "2021-01-01 23:00:00"]) == 0
    assert main(["show", "--warehouse", wh, "--table", "rep_fraud"]) == 0
    out = capsys.readouterr().out
    assert "report batch" in out and "P1" in out
    q = "SELECT passport, event_type, count(*) AS n FROM rep_fraud GROUP BY passport, event_type"
    assert main(["sql", "--warehouse", wh, "--query", q]) == 0
    assert "P1" in capsys.readouterr().out
