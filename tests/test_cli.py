"""The command line runs both applications end to end (in-process session)."""

import datetime as dt

from pyspark.sql import functions as F

from logwise.__main__ import run
from logwise.streaming import level_totals
from conftest import rows, write_lines


def test_cli_logs_once(spark, tmp):
    write_lines(f"{tmp}/in", "a.log", ["[error]\tmain\tDate:20200606215836"] * 2 + ["[info]\tx\tDate:20200606215837"])
    assert run(["logs", "--input", f"{tmp}/in", "--output", f"{tmp}/out", "--checkpoint", f"{tmp}/ck", "--once"], spark) == 0
    totals = level_totals(spark, f"{tmp}/out/levels")
    assert rows(totals) == [("[error]", 2), ("[info]", 1)]


def test_cli_comments_and_totals(spark, tmp, capsys):
    spark.createDataFrame([("狗",), ("酒",)], "word string").write.parquet(f"{tmp}/dict")
    spark.createDataFrame(
        [("狗 酒 狗", dt.datetime(2018, 8, 5, 10)), ("狗", dt.datetime(2018, 8, 5, 11)), ("猫", None)],
        "value string, timestamp timestamp",
    ).write.parquet(f"{tmp}/in")
    args = ["comments", "--input", f"{tmp}/in", "--dictionary", f"{tmp}/dict", "--ledger", f"{tmp}/ledger",
            "--checkpoint", f"{tmp}/ck", "--once"]
    assert run(args, spark) == 0
    from logwise.sinks import monthly_totals

    got = rows(monthly_totals(spark, f"{tmp}/ledger").where(F.col("month") == "201808").select("word", "count"))
    assert got == [("狗", 2), ("酒", 1)]
    assert run(["totals", "--ledger", f"{tmp}/ledger", "--month", "201808"], spark) == 0
    assert "狗" in capsys.readouterr().out
