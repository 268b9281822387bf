"""Flags under changes and many periods at once, against full recomputation."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random

import pytest

from tests.conftest import fresh, rows
from wardlens.operators.derive import with_readmission_flag
from wardlens.plans import compute_indicators
from wardlens.plans.flags import FlagStore
from wardlens.plans.indicators import INDICATOR_COLUMNS
from wardlens.plans.periods import (Slots, compute_indicators_periods, period_states,
                                    rolling_periods)
from wardlens.sources.model import Tables
from wardlens.sources.versions import Conflict

D0 = dt.date(2024, 1, 1)
TYPES = ["inpatient", "inpatient", "emergency", "outpatient", None]


def _encounter(rng, i):
    start = None if rng.random() < 0.05 else D0 + dt.timedelta(days=rng.randrange(200))
    stay = None if start is None or rng.random() < 0.2 else start + dt.timedelta(days=rng.randrange(9))
    return {"EncounterID": i, "PatientID": rng.choice([None, *range(1, 25), 1, 1, 1]),
            "DepartmentID": rng.choice([None, 1, 2, 3]), "EncounterType": rng.choice(TYPES),
            "EncounterDate": start, "DischargeDate": stay}


def _files(store):
    root = store.table.root.removeprefix("file:")
    return {b: sorted(os.path.basename(f) for f in glob.glob(f"{root}/{folder}/*.parquet"))
            for b, folder in store.table.parts().items()}


def test_random_changes_equal_a_full_recompute(spark, make):
    rng = random.Random(5)
    state = {i: _encounter(rng, i) for i in range(300)}
    store = FlagStore(spark, fresh(spark, "test-flags"), buckets=12)
    store.build(make("encounters", list(state.values())))
    for step in range(4):
        before = _files(store)
        removed = rng.sample(sorted(state), 3) + [10 ** 6]
        changed = rng.sample(sorted(set(state) - set(removed)), 3)
        added = range(1000 + 10 * step, 1003 + 10 * step)
        for i in removed:
            state.pop(i, None)
        new = [_encounter(rng, i) for i in (*changed, *added)]
        state |= {r["EncounterID"]: r for r in new}
        touched = store.apply(make("encounters", new), spark.createDataFrame(
            [(i,) for i in removed], "EncounterID long"))
        want = with_readmission_flag(make("encounters", list(state.values())))
        assert rows(store.read(), "EncounterID", "IsReadmission") == rows(want, "EncounterID", "IsReadmission")
        assert rows(store.read(), *store.base.names) == rows(want, *store.base.names)
        after = _files(store)
        assert touched and all(after[b] == before[b] for b in before if b not in touched)
        assert set(touched) < set(before) | set(after)


def test_changes_at_the_window_edges(spark, make):
    def enc(i, start, days=None, kind="outpatient"):
        return {"EncounterID": i, "PatientID": 7, "EncounterType": kind,
                "EncounterDate": D0 + dt.timedelta(days=start),
                "DischargeDate": None if days is None else D0 + dt.timedelta(days=start + days)}
    store = FlagStore(spark, fresh(spark, "test-flags-edges"), buckets=4)
    store.build(make("encounters", [enc(i, d) for i, d in enumerate((10, 11, 40, 41))]))
    assert {f for _, f in rows(store.read(), "EncounterID", "IsReadmission")} == {"No"}
    store.apply(make("encounters", [enc(9, 5, 5, "inpatient")]))  # discharged on day 10
    assert rows(store.read(), "EncounterID", "IsReadmission") == [
        (0, "No"), (1, "Yes"), (2, "Yes"), (3, "No"), (9, "No")]
    store.apply(removed=spark.createDataFrame([(9,)], "EncounterID long"))
    assert {f for _, f in rows(store.read(), "EncounterID", "IsReadmission")} == {"No"}
    assert store.apply(removed=spark.createDataFrame([(9,)], "EncounterID long")) == []
    with pytest.raises(ValueError, match="twice"):
        store.apply(make("encounters", [enc(20, 1), enc(20, 2)]))


def test_flag_store_empty_and_conflict(spark, make):
    store = FlagStore(spark, fresh(spark, "test-flags-empty"), buckets=4)
    store.build(make("encounters", []))
    assert store.read().count() == 0
    rng = random.Random(1)
    store.apply(make("encounters", [_encounter(rng, i) for i in range(20)]))
    assert store.read().count() == 20
    version = store.table.newest()
    name = next(iter(store.table.parts()))
    store.table.commit(version, {name: "data/x/other"})
    with pytest.raises(Conflict):
        store.table.commit(version, {name: "data/y/other"})


def _model(make, n=600):
    rng = random.Random(8)
    zips = ["12307", "12303", "12301", "99999", None]
    return Tables(
        departments=make("departments", [{"DepartmentID": d, "DepartmentName": f"d{d}", "BedCapacity": b}
                                         for d, b in ((1, 4), (2, None), (3, 0), (4, 9))]),
        patients=make("patients", [{"PatientID": p, "Zip": rng.choice(zips)} for p in range(1, 25)]),
        staff=make("staff", [{"StaffID": s, "DepartmentID": rng.choice([1, 2, 3, None]), "Role": "nurse",
                              "EmploymentStatus": rng.choice(["active", "on leave"])} for s in range(12)]),
        encounters=make("encounters", [_encounter(rng, i) for i in range(n)]))


@pytest.mark.parametrize("stored", [False, True])
def test_many_periods_equal_one_call_each(spark, make, stored):
    t = _model(make)
    if stored:
        t.encounters = with_readmission_flag(t.encounters)
    rng = random.Random(3)
    periods = rolling_periods(dt.date(2023, 12, 1), 8, 3) + [
        (D0, D0), (dt.date(1990, 1, 1), dt.date(1990, 12, 31)), (D0, dt.date(2030, 1, 1))]
    periods += [(a, a + dt.timedelta(days=rng.randrange(60)))
                for a in (D0 + dt.timedelta(days=rng.randrange(200)) for _ in range(5))]
    got = compute_indicators_periods(t, periods + periods[:2], D0).collect()
    want = []
    for p in periods:
        want += rows(compute_indicators(t, *p, computed_on=D0), *INDICATOR_COLUMNS)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_many_periods_read_each_fact_once(spark, make):
    t = _model(make, 20)
    path = fresh(spark, "test-periods-facts")
    t.encounters.write.mode("overwrite").parquet(path)
    t.encounters = spark.read.schema(t.encounters.schema).parquet(path)
    states = period_states(t, Slots(t, rolling_periods(D0, 36, 6)))
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("hashpartitioning(kind") == 1
    assert "PushedFilters: [Or(" in plan
    result = compute_indicators_periods(t, rolling_periods(D0, 36, 6), D0)
    assert path.split("/")[-1] not in " ".join(result.inputFiles())
    with pytest.raises(ValueError, match="Invalid reporting period"):
        Slots(t, [(D0, D0 - dt.timedelta(days=1))])
