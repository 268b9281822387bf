from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from wardlens.operators.derive import (with_catchment_area, with_length_of_stay,
                                       with_readmission_flag)

D0 = dt.date(2024, 3, 1)


def d(n: int) -> dt.date:
    return D0 + dt.timedelta(days=n)


def enc(eid, pid, etype, start, discharge=None):
    return {"EncounterID": eid, "PatientID": pid, "EncounterType": etype,
            "EncounterDate": start, "DischargeDate": discharge}


def test_length_of_stay_open_and_same_day(make):
    df = make("encounters", [enc(1, 1, "inpatient", d(0), d(3)),
                             enc(2, 1, "outpatient", d(5), d(5)),
                             enc(3, 1, "inpatient", d(7), None)])
    assert rows(with_length_of_stay(df), "EncounterID", "LengthOfStayDays") == [
        (1, 3), (2, 0), (3, None)]


def test_catchment_area_unknown_and_null_zip(make):
    df = make("patients", [{"PatientID": 1, "Zip": "12307"}, {"PatientID": 2, "Zip": "12304"},
                           {"PatientID": 3, "Zip": "12302"}, {"PatientID": 4, "Zip": "99999"},
                           {"PatientID": 5, "Zip": None}])
    assert rows(with_catchment_area(df), "PatientID", "CatchmentArea") == [
        (1, "HSA-1"), (2, "HSA-2"), (3, "HSA-3"), (4, "Unassigned"), (5, "Unassigned")]


READMIT_FIXTURE = [
    enc(1, 1, "inpatient", d(0), d(2)),      # prior stay, discharged day 2
    enc(2, 1, "outpatient", d(2), d(2)),     # on the discharge day -> No
    enc(3, 1, "emergency", d(3), d(3)),      # +1 -> Yes
    enc(4, 1, "observation", d(32), d(32)),  # +30 -> Yes
    enc(5, 1, "outpatient", d(33), d(33)),   # +31 -> No
    enc(6, 2, "inpatient", d(0), d(1)),      # two matching prior stays
    enc(7, 2, "inpatient", d(2), d(4)),
    enc(8, 2, "outpatient", d(10), d(10)),   # matches both -> one Yes row
    enc(9, 3, "inpatient", d(0), None),      # open prior stay -> never matches
    enc(10, 3, "outpatient", d(5), d(5)),
    enc(11, 4, "emergency", d(0), d(1)),     # prior emergency only -> No
    enc(12, 4, "outpatient", d(5), d(5)),
    enc(13, 5, "outpatient", d(3), d(3)),    # same date as patient 1's match -> No
    enc(14, None, "outpatient", d(3), d(3)),
]
READMIT_EXPECTED = {1: "No", 2: "No", 3: "Yes", 4: "Yes", 5: "No", 6: "No", 7: "Yes",
                    8: "Yes", 9: "No", 10: "No", 11: "No", 12: "No", 13: "No", 14: "No"}


def test_readmission_boundaries_both_methods(make):
    df = make("encounters", READMIT_FIXTURE)
    for method, salt in (("bucketed", 1), ("window", 1), ("bucketed", 4), ("bucketed", "auto"),
                         ("window", "auto")):
        out = with_readmission_flag(df, method=method, salt=salt)
        assert out.count() == len(READMIT_FIXTURE)
        got = dict(rows(out, "EncounterID", "IsReadmission"))
        assert got == READMIT_EXPECTED, (method, salt)


def test_readmission_prior_frame_and_window(make):
    df = make("encounters", READMIT_FIXTURE)
    subset = df.where("EncounterID in (3, 4, 5)")
    got = dict(rows(with_readmission_flag(subset, prior=df), "EncounterID", "IsReadmission"))
    assert got == {3: "Yes", 4: "Yes", 5: "No"}
    got = dict(rows(with_readmission_flag(df, window_days=31), "EncounterID", "IsReadmission"))
    assert got[5] == "Yes"
    got = dict(rows(with_readmission_flag(df, window_days=0), "EncounterID", "IsReadmission"))
    assert set(got.values()) == {"No"}


def _brute(encs, window=30):
    out = {}
    for e in encs:
        hit = any(p["PatientID"] == e["PatientID"] and e["PatientID"] is not None
                  and p["EncounterType"] == "inpatient" and p["DischargeDate"] is not None
                  and p["DischargeDate"] < e["EncounterDate"]
                  <= p["DischargeDate"] + dt.timedelta(days=window)
                  for p in encs)
        out[e["EncounterID"]] = "Yes" if hit else "No"
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["inpatient", "emergency",
                                                              "outpatient"]),
                          st.integers(-40, 120), st.one_of(st.none(), st.integers(0, 12))),
                min_size=1, max_size=40),
       st.sampled_from([1, 7, 30]))
def test_readmission_methods_equal_brute_force(make, data, window):
    encs = [enc(i, pid, t, d(s), None if los is None else d(s + los))
            for i, (pid, t, s, los) in enumerate(data)]
    df = make("encounters", encs)
    expected = _brute(encs, window)
    for method, salt in (("bucketed", 1), ("window", 1), ("bucketed", "auto")):
        got = dict(rows(with_readmission_flag(df, window_days=window, method=method,
                                              salt=salt),
                        "EncounterID", "IsReadmission"))
        assert got == expected, (method, salt)
