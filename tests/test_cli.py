"""The batch entry point over model tables written as Parquet."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from wardlens.__main__ import main
from wardlens.plans.publish import read_indicators
from wardlens.session import shared_dir
from wardlens.sources import driver_tables, write_tables

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="benchmark tables missing")
def test_cli_report_indicators_checks(spark):
    root = shared_dir(spark, "test-cli")
    write_tables(driver_tables(spark, SF), f"{root}/model")
    assert main(["report", "risk_tiers", "--tables", f"{root}/model",
                 "--out", f"{root}/out/risk"], spark=spark) == 0
    assert spark.read.parquet(f"{root}/out/risk").count() == 20
    start, end = dt.date(1996, 1, 1), dt.date(1997, 12, 31)
    assert main(["indicators", "--tables", f"{root}/model", "--start", str(start),
                 "--end", str(end), "--publish", f"{root}/qi", "--computed-on", "2026-05-15",
                 "--out", f"{root}/out/qi"], spark=spark) == 0
    assert read_indicators(spark, f"{root}/qi", start, end).count() == \
        spark.read.parquet(f"{root}/out/qi").count() > 0
    assert main(["checks", "--tables", f"{root}/model", "--out", f"{root}/out/checks"],
                spark=spark) == 0
    keys = spark.read.parquet(f"{root}/out/checks/primary_and_unique_keys")
    assert keys.where("TableName = 'encounters'").first().DuplicateKeys == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="benchmark tables missing")
def test_cli_prints_all_rows_and_takes_parameters(spark, capsys):
    root = shared_dir(spark, "test-cli-print")
    write_tables(driver_tables(spark, SF), f"{root}/model")

    def lines(*args):
        assert main(["report", *args, "--tables", f"{root}/model"], spark=spark) == 0
        return [x for x in capsys.readouterr().out.splitlines() if "\t" in x]

    assert len(lines("costliest_stays")) > 51
    assert len(lines("low_stock")) == 6 and len(lines("low_stock", "--n", "2")) == 3
    assert len(lines("low_stock", "--n", "0")) > 6
    assert len(lines("costliest_stays", "--k", "1")) < len(lines("costliest_stays"))


@pytest.mark.skipif(not os.path.exists(SF), reason="benchmark tables missing")
def test_cli_derive_then_report_with_stored_columns(spark):
    root = shared_dir(spark, "test-cli-derive")
    write_tables(driver_tables(spark, SF), f"{root}/model")
    assert main(["derive", "--tables", f"{root}/model", "--out", f"{root}/derived"],
                spark=spark) == 0
    enc = spark.read.parquet(f"{root}/derived/encounters")
    assert {"IsReadmission", "LengthOfStayDays"} <= set(enc.columns)
    for flag in ([], ["--derived"]):
        assert main(["report", "risk_tiers", "--tables", f"{root}/derived", *flag,
                     "--out", f"{root}/out/risk{len(flag)}"], spark=spark) == 0
    a = spark.read.parquet(f"{root}/out/risk0").collect()
    b = spark.read.parquet(f"{root}/out/risk1").collect()
    assert sorted(a) == sorted(b) and len(a) == 20
