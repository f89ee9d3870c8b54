"""The command line lists and runs registered queries."""

from ledgerlens.__main__ import main

from conftest import SF_SMALL


def test_list(capsys):
    assert main(["list"]) == 0
    names = capsys.readouterr().out.split()
    assert "agg_daily_store_product" in names and "mv_query_one_dim" in names


def test_run_writes_result(spark, scratch):
    out = scratch + "/best"
    assert main(["run", "q_best_product", "--sf-dir", SF_SMALL, "--out", out]) == 0
    assert spark.read.parquet(out).count() == 1


def test_unknown_query(capsys):
    assert main(["run", "nope", "--sf-dir", SF_SMALL]) == 2
