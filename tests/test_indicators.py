from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardlens.plans import (bed_utilization_rate, compute_indicators,
                            first_encounter_complication_rate, indicator_report,
                            provider_workload_index, readmission_rate, validate_period)
from wardlens.sources.model import Tables

S, E = dt.date(2024, 1, 1), dt.date(2024, 1, 10)  # 10 days
ON = dt.date(2024, 2, 1)


def day(n):
    return S + dt.timedelta(days=n)


def test_validate_period():
    assert validate_period(S, S) == 1
    assert validate_period(S, E) == 10
    for a, b in [(E, S), (None, E), (S, None)]:
        with pytest.raises(ValueError, match="Invalid reporting period"):
            validate_period(a, b)


@pytest.fixture
def model(make):
    deps = make("departments", [
        {"DepartmentID": 1, "DepartmentName": "A", "BedCapacity": 2},
        {"DepartmentID": 2, "DepartmentName": "B", "BedCapacity": None},
        {"DepartmentID": 3, "DepartmentName": "C", "BedCapacity": 0},
        {"DepartmentID": 4, "DepartmentName": "D", "BedCapacity": 1},
    ])
    pts = make("patients", [{"PatientID": 1, "Zip": "12307"}, {"PatientID": 2, "Zip": "12307"},
                            {"PatientID": 3, "Zip": "12303"}])
    staff = make("staff", [
        {"StaffID": 1, "DepartmentID": 1, "Role": "nurse", "EmploymentStatus": "active"},
        {"StaffID": 2, "DepartmentID": 1, "Role": "consultant", "EmploymentStatus": "active"},
        {"StaffID": 3, "DepartmentID": 1, "Role": "nurse", "EmploymentStatus": "on leave"},
        {"StaffID": 4, "DepartmentID": 2, "Role": "pharmacist", "EmploymentStatus": "active"},
        {"StaffID": 5, "DepartmentID": 3, "Role": "resident", "EmploymentStatus": "active"},
    ])
    I, O, X = "inpatient", "outpatient", "emergency"
    encs = [
        # (id, patient, dept, type, start, discharge)
        (1, 1, 1, O, -5, -5),   # first of all time, before the period: ignored
        (2, 1, 1, X, 2, 2),     # patient 1 first in period: tie on day 2, lower id wins
        (3, 1, 1, O, 2, 2),
        (4, 2, 1, I, 0, 3),     # LOS 3, admitted in period
        (5, 2, 1, O, 4, 4),     # readmission (outpatient, not in readmission scope)
        (6, 2, 1, X, 5, 5),     # readmission in scope
        (7, 3, 1, I, 9, 15),    # crosses the period end: 6 bed-days, not clipped
        (8, 3, 2, I, 1, 4),     # department without beds
        (9, 3, 3, I, 1, 4),     # department with 0 beds
        (10, 3, 1, I, 3, 3),    # LOS 0 is not counted
        (11, 3, 4, I, 11, 12),  # admitted after the period
    ]
    enc = make("encounters", [
        {"EncounterID": i, "PatientID": p, "DepartmentID": dep, "EncounterType": t,
         "EncounterDate": day(s), "DischargeDate": day(x)} for i, p, dep, t, s, x in encs])
    return Tables(departments=deps, patients=pts, staff=staff, encounters=enc)


def test_readmission_rate(model):
    got = rows(readmission_rate(model.encounters, model.patients, S, E, ON),
               "CatchmentArea", "Numerator", "Denominator", "ComputedValue", "SeverityFlag")
    # HSA-1 scope: enc 2 (X), 4 (I), 6 (X, after enc 4's discharge) -> 1/3;
    # HSA-2 scope: 7, 8, 9, 10 -> enc 7 (day 9) follows the day-4 discharges -> 1/4
    assert got == [("HSA-1", 1.0, 3.0, 33.3, "critical"), ("HSA-2", 1.0, 4.0, 25.0, "critical")]
    window = rows(readmission_rate(model.encounters, model.patients, S, E, ON, method="window"),
                  "CatchmentArea", "Numerator")
    assert window == [("HSA-1", 1.0), ("HSA-2", 1.0)]


def test_first_encounter(model):
    got = rows(first_encounter_complication_rate(model.encounters, model.patients, S, E, ON),
               "CatchmentArea", "Numerator", "Denominator", "ComputedValue", "SeverityFlag")
    # patient 1 -> enc 2 (emergency), patient 2 -> enc 4 (inpatient), patient 3 -> enc 8/9 (day 1)
    assert got == [("HSA-1", 2.0, 2.0, 100.0, "critical"), ("HSA-2", 1.0, 1.0, 100.0, "critical")]


def test_bed_utilization(model):
    got = rows(bed_utilization_rate(model.encounters, model.departments, S, E, ON),
               "DepartmentID", "Numerator", "Denominator", "ComputedValue")
    assert got == [(1, 9.0, 20.0, 45.0)]


def test_provider_workload(model):
    got = rows(provider_workload_index(model.encounters, model.staff, S, E, ON),
               "DepartmentID", "Numerator", "Denominator", "ComputedValue", "SeverityFlag")
    # dept 1: encounters 2-7 and 10 in the period / (2 active clinical staff x 10 days)
    # = 0.35; dept 2: no clinical staff -> dropped; dept 3: 1 / (1 x 10) = 0.1;
    # dept 4: no encounter in the period -> dropped
    assert got == [(1, 7.0, 20.0, 0.35, "elevated"), (3, 1.0, 10.0, 0.1, "normal")]


def test_compute_and_report(model):
    ind = compute_indicators(model, S, E, ON)
    assert ind.columns == ["DepartmentID", "CatchmentArea", "IndicatorName",
                           "ReportingPeriodStart", "ReportingPeriodEnd", "Numerator",
                           "Denominator", "ComputedValue", "SeverityFlag",
                           "ComputationDate", "DerivationRule"]
    all_rows = ind.collect()
    assert len(all_rows) == 2 + 2 + 1 + 2
    assert {r.ReportingPeriodStart for r in all_rows} == {S}
    assert {r.ComputationDate for r in all_rows} == {ON}
    rep = indicator_report(ind, model.departments).collect()
    assert [(r.IndicatorName, r.CatchmentArea, r.DepartmentName) for r in rep][:3] == [
        ("bed_utilization_rate", "-", "A"),
        ("first_encounter_complication_rate", "HSA-1", "-"),
        ("first_encounter_complication_rate", "HSA-2", "-")]
    with pytest.raises(ValueError):
        compute_indicators(model, E, S)


def test_severity_at_cutoffs(make):
    # 1 readmission of 10 = exactly 10.0 -> elevated, not critical
    pts = make("patients", [{"PatientID": 1, "Zip": "12301"}])
    encs = [{"EncounterID": 0, "PatientID": 1, "EncounterType": "inpatient",
             "EncounterDate": day(0), "DischargeDate": day(0)}]
    encs += [{"EncounterID": i, "PatientID": 1, "EncounterType": "emergency",
              "EncounterDate": day(i * 40), "DischargeDate": day(i * 40)} for i in range(1, 9)]
    encs += [{"EncounterID": 9, "PatientID": 1, "EncounterType": "emergency",
              "EncounterDate": day(1), "DischargeDate": day(1)}]
    enc = make("encounters", encs)
    r = readmission_rate(enc, pts, S, day(400), ON).first()
    assert (r.Numerator, r.Denominator, r.ComputedValue, r.SeverityFlag) == (1.0, 10.0, 10.0,
                                                                              "elevated")


def test_first_encounter_methods_agree(model):
    a = first_encounter_complication_rate(model.encounters, model.patients, S, E, ON)
    b = first_encounter_complication_rate(model.encounters, model.patients, S, E, ON,
                                          method="row_number")
    assert rows(a) == rows(b)


def test_one_day_period(model):
    ind = compute_indicators(model, day(2), day(2), ON)
    wl = ind.where("IndicatorName = 'provider_workload_index'").collect()
    # day 2: encounters 2 and 3, two active clinical staff, one day
    assert [(r.DepartmentID, r.Numerator, r.Denominator, r.ComputedValue) for r in wl] == [
        (1, 2.0, 2.0, 1.0)]
    assert {r.SeverityFlag for r in wl} == {"critical"}


def test_stored_flag_is_used_when_present(model):
    """A stored IsReadmission (which may disagree with the rule) is used as is."""
    stored = model.encounters.withColumn(
        "IsReadmission", F.when(F.col("EncounterID").isin(2, 7), "Yes").otherwise("No"))
    got = rows(readmission_rate(stored, model.patients, S, E, ON),
               "CatchmentArea", "Numerator", "Denominator")
    assert got == [("HSA-1", 1.0, 3.0), ("HSA-2", 1.0, 4.0)]
