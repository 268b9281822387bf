"""Reports from states against the reports over the facts of a range."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import fresh, rows
from wardlens.operators import (average_los, chronic_complications, claim_lag, complaint_clusters,
                                cost_by_type, denial_rate, referral_rejection, satisfaction_gap)
from wardlens.plans.states import REPORTS, ReportStates, replay_facts, report_states
from wardlens.sources.model import Tables

D0 = dt.date(2024, 1, 1)


def _day(rng):
    return None if rng.random() < 0.1 else D0 + dt.timedelta(days=rng.randrange(60))


def _facts(rng, first, n):
    enc = [{"EncounterID": first + i, "PatientID": rng.choice([None, 1, 2, 3]),
            "DepartmentID": rng.choice([None, 1, 2, 3, 9]), "EncounterDate": _day(rng),
            "EncounterType": rng.choice(["inpatient", "emergency", "outpatient", None]),
            "DischargeDate": _day(rng), "InsuranceType": rng.choice(["A", "B", None]),
            "ChiefComplaint": rng.choice(["Asthma", "diabetic", "fever", None]),
            "EncounterCost": rng.choice([None, 1.005, 20.0, 0.1])} for i in range(n)]
    some = lambda: first + rng.randrange(n)
    return {
        "encounters": enc,
        "billing_claims": [{"ClaimID": first + i, "EncounterID": some(), "DateSubmitted": _day(rng),
                            "ClaimStatus": rng.choice(["denied", "paid", None]),
                            "BilledAmount": rng.choice([None, 0.1, 7.25, 100.0])} for i in range(2 * n)],
        "satisfaction_surveys": [{"SurveyID": first + i, "EncounterID": some(), "SurveyDate": _day(rng),
                                  "StaffRating": rng.choice([None, 1, 2, 5]),
                                  "FacilityRating": rng.choice([None, 3, 4])} for i in range(n)],
        "referrals": [{"ReferralID": first + i, "ReceivingHospital": rng.choice(["X", "Y", None]),
                       "Status": rng.choice(["rejected", "accepted", None]), "DateRequested": _day(rng),
                       "ReferralDirection": rng.choice(["outgoing", "incoming"])} for i in range(n)],
    }


def _direct(name, t, start, end):
    def within(df, col):
        return df if start is None else df.where(F.col(col).between(F.lit(start), F.lit(end)))
    enc, claims = t.encounters, t.billing_claims
    dated = within(enc, "EncounterDate")
    return {
        "average_los": lambda: average_los(dated, t.departments),
        "cost_by_type": lambda: cost_by_type(dated),
        "complaint_clusters": lambda: complaint_clusters(dated),
        "chronic_complications": lambda: chronic_complications(dated, t.patients),
        "claim_lag": lambda: claim_lag(claims, dated, t.departments),
        "denial_rate": lambda: denial_rate(within(claims, "DateSubmitted"), enc, t.departments),
        "satisfaction_gap": lambda: satisfaction_gap(within(t.satisfaction_surveys, "SurveyDate"), enc,
                                                     t.departments),
        "referral_rejection": lambda: referral_rejection(within(t.referrals, "DateRequested")),
    }[name]()


def test_states_equal_the_reports_over_any_range(spark, make):
    rng = random.Random(21)
    dims = {"departments": make("departments", [{"DepartmentID": d, "DepartmentName": n}
                                                for d, n in ((1, "A"), (2, "A"), (3, "C"))]),
            "patients": make("patients", [{"PatientID": p, "Zip": z}
                                          for p, z in ((1, "12307"), (2, "12303"), (3, None))])}

    def tables(parts):
        held = {}
        for part in parts:
            for name, r in part.items():
                held.setdefault(name, []).extend(r)
        return Tables(**dims, **{n: make(n, r) for n, r in held.items()})

    first, second, third = _facts(rng, 0, 60), _facts(rng, 1000, 40), _facts(rng, 2000, 30)
    states = ReportStates(spark, fresh(spark, "test-states"))
    assert states.apply("a", tables([first, second]))
    assert states.apply("b", tables([third]), before=tables([second]))
    assert not states.apply("a", tables([first]))
    now = tables([first, third])
    ranges = [(None, None), (D0 + dt.timedelta(days=11), D0 + dt.timedelta(days=30))]
    for turn in range(2):
        for name in REPORTS:
            for start, end in ranges:
                got = states.report(name, now.departments, start, end)
                want = _direct(name, now, start, end)
                assert got.columns == want.columns and rows(got) == rows(want), (name, start, turn)
                assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        states.compact()
    assert not states.apply("b", tables([third]))
    assert states.report("cost_by_type", None, dt.date(1990, 1, 1), dt.date(1990, 2, 1)).count() == 0


def test_no_states_and_pushed_ranges(spark, make):
    states = ReportStates(spark, fresh(spark, "test-states-empty"))
    assert states.report("cost_by_type").count() == 0
    assert states.apply("none") and not states.apply("none")
    states.compact()
    states.apply("one", Tables(referrals=make("referrals", [
        {"ReferralID": 1, "ReceivingHospital": "X", "DateRequested": D0, "ReferralDirection": "outgoing"}])))
    found = states.report("referral_rejection", None, D0, D0)
    assert rows(found) == [("X", 1, 0, 0.0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("DataFilters"):]
    assert "referral_rejection" in filters and "(day" in filters
    with pytest.raises(KeyError):
        states.report("unknown")


def test_facts_are_summed_once(spark, make):
    rng = random.Random(3)
    t = Tables(patients=make("patients", [{"PatientID": 1, "Zip": "12307"}]),
               **{n: make(n, r) for n, r in _facts(rng, 0, 20).items()})
    found = report_states([(t, 1), (t, -1)])
    assert all(v == 0 for r in found.collect() for v in r[4:])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # One aggregate; encounters meet patients once, and claims and surveys once.
    assert plan.count("Aggregate ") == 1 and plan.count("Join ") == 2
    assert report_states([]) is None and report_states([(Tables(patients=t.patients), 1)]) is None
