"""The driver contract, and every registered query against its SQL oracle on
the smallest benchmark tables."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from wardlens.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="benchmark tables missing")


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def test_contract_keys():
    q, s = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(s) <= set(q) and set(QUERIES) <= set(s)
    assert len(QUERIES) >= 30


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["DepartmentID", "CatchmentArea", "IndicatorName"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for v in VIEWS:
        c.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SF}/{v}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(entry_mod.oracle_sql()[name])
    want = res.fetchall()
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, got) == _canon(dcols, want)


SHUFFLE_JOIN_QUERIES = ["readmission_flag", "readmission_rate", "risk_tiers", "claim_lag",
                        "denial_rate", "infection_exposure", "chronic_complications",
                        "orphans", "all_indicators"]


def test_shuffle_join_paths_match_oracle(spark, con):
    """The same answers when no join may broadcast (the shapes a large run
    takes: sort-merge joins, the range join's residual condition)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for name in SHUFFLE_JOIN_QUERIES:
            df = entry_mod.queries()[name](spark, SF)
            got = [tuple(r) for r in df.collect()]
            res = con.execute(entry_mod.oracle_sql()[name])
            want, dcols = res.fetchall(), [d[0] for d in res.description]
            assert _canon(df.columns, got) == _canon(dcols, want), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_entry_without_the_training_data_operators(tmp_path):
    """Without the subpackage, and with an empty folder in its place."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "repo"
    shutil.copytree(os.path.join(root, "wardlens"), copy / "wardlens",
                    ignore=shutil.ignore_patterns("__pycache__", "llm"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), copy)
    code = ("import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) == set(q); "
            "assert not [n for n in q if n.startswith('op') and '_' in n and n[2].isdigit()]; print(len(q))")
    for leftover in (False, True):
        if leftover:
            (copy / "wardlens" / "llm").mkdir()
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=False)
        assert out.returncode == 0 and int(out.stdout) == len(QUERIES), out.stderr
