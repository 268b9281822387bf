"""Physical-plan properties of the registered queries: the shapes the library
relies on at scale, asserted on the plans Spark actually builds."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import rows
from wardlens.operators.derive import with_readmission_flag
from wardlens.plans.catalog import QUERIES, WRITING

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="benchmark tables missing")


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan(fn(spark, SF)) for n, fn in QUERIES.items() if n not in WRITING}


def test_no_pairs_no_python(plans):
    for name, p in plans.items():
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                    "ArrowEvalPython", "PythonUDF"):
            assert bad not in p, (name, bad)


def test_period_filter_reaches_scan(plans):
    for name in ("all_indicators", "first_encounter_complication_rate",
                 "provider_workload_index", "bed_utilization_rate"):
        assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in plans[name], name


def test_readmission_join_is_bucketed(plans):
    p = plans["readmission_flag"]
    assert "LeftSemi" in p
    # the equi-join keys are (patient, bucket); the date range is residual
    assert "Left keys [2]" in p and "dbucket" in p


def test_top_k_per_group_is_limited_before_shuffle(plans):
    assert "WindowGroupLimit" in plans["costliest_stays"]
    assert "TakeOrderedAndProject" in plans["low_stock"]
    assert "TakeOrderedAndProject" in plans["risk_tiers"]


def test_dimension_is_broadcast_by_its_bytes(spark, plans):
    """Spark decides from the measured size: no hint, and another way beyond it."""
    assert "BroadcastHashJoin" in plans["low_stock"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(QUERIES["low_stock"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_job_starts_while_a_plan_is_built(spark):
    group = "test-plan-building"
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, "plans")
    try:
        for name, fn in QUERIES.items():
            if name not in WRITING:
                fn(spark, SF)
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_flag_key_is_split_by_default(make):
    """The join back to the flag carries a salt next to (patient, day)."""
    enc = make("encounters", [{"EncounterID": 1, "PatientID": 1}])
    assert "_salt" in plan(with_readmission_flag(enc))


def test_column_pruning(plans):
    # the low-stock scan of `part` reads only the columns it needs
    scan = [ln for ln in plans["low_stock"].splitlines() if "ReadSchema" in ln and "p_" in ln]
    assert scan and "p_name" in scan[0] and "p_brand" not in scan[0] and "p_type" not in scan[0]


def test_hot_patient_is_handled_without_pairs(make):
    """One patient holding most encounters, many on the same days: the flag
    must still equal the rule (computed here from day-level facts)."""
    base = dt.date(2024, 1, 1)
    encs = []
    for i in range(3000):
        day = base + dt.timedelta(days=i % 90)
        etype = "inpatient" if i % 7 == 0 else "outpatient"
        encs.append({"EncounterID": i, "PatientID": 1, "EncounterType": etype,
                     "EncounterDate": day, "DischargeDate": day + dt.timedelta(days=i % 3)})
    encs.append({"EncounterID": 9999, "PatientID": 2, "EncounterType": "outpatient",
                 "EncounterDate": base, "DischargeDate": base})
    df = make("encounters", encs)
    dis = {e["DischargeDate"] for e in encs if e["EncounterType"] == "inpatient"
           and e["PatientID"] == 1}
    expect = {e["EncounterID"]: "Yes" if e["PatientID"] == 1 and any(
        d < e["EncounterDate"] <= d + dt.timedelta(days=30) for d in dis) else "No"
        for e in encs}
    for method, salt in (("bucketed", 1), ("window", 1), ("bucketed", 8), ("bucketed", "auto")):
        got = dict(rows(with_readmission_flag(df, method=method, salt=salt),
                        "EncounterID", "IsReadmission"))
        assert got == expect, (method, salt)


def test_readmission_rate_shares_its_per_day_aggregate(spark):
    """The totals and the readmission match use one scan and shuffle of the
    per-(patient, day) counts (visible as a reused exchange)."""
    df = entry_mod.queries()["readmission_rate"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_auto_salt_splits_only_hot_keys(spark, make):
    """One (patient, day) holds most rows: salt="auto" spreads it over many
    join keys, while every other key keeps a single one."""
    from pyspark.sql import functions as F
    from wardlens.operators.derive import HOT_SHARE
    base = dt.date(2024, 1, 1)
    encs = [{"EncounterID": i, "PatientID": 1, "EncounterType": "outpatient",
             "EncounterDate": base + dt.timedelta(days=40), "DischargeDate": None}
            for i in range(3000)]
    encs += [{"EncounterID": 10_000 + i, "PatientID": 2 + i, "EncounterType": "inpatient",
              "EncounterDate": base, "DischargeDate": base + dt.timedelta(days=1)}
             for i in range(500)]
    encs.append({"EncounterID": 99_999, "PatientID": 1, "EncounterType": "inpatient",
                 "EncounterDate": base + dt.timedelta(days=20),
                 "DischargeDate": base + dt.timedelta(days=25)})
    df = make("encounters", encs)
    out = with_readmission_flag(df, salt="auto")
    got = dict(rows(out, "EncounterID", "IsReadmission"))
    assert all(got[i] == "Yes" for i in range(3000))  # day 40 follows the day-25 discharge
    assert sum(v == "Yes" for v in got.values()) == 3000
    # the hot key is split in proportion to its share of the rows
    total = len(encs)
    parts = -(-3000 * HOT_SHARE // total)
    hot = (df.where((F.col("PatientID") == 1)
                    & (F.col("EncounterDate") == base + dt.timedelta(days=40)))
           .select(F.pmod(F.xxhash64("EncounterID"), F.lit(parts)).alias("s"))
           .distinct().count())
    assert hot > 100
