from __future__ import annotations

import datetime as dt

from tests.conftest import rows
from wardlens.operators import (average_los, chronic_complications, claim_lag,
                                complaint_clusters, cost_by_type, costliest_stays,
                                denial_rate, expiry_watch, infection_exposure,
                                inventory_value, low_stock, referral_rejection,
                                risk_tiers, satisfaction_gap, vaccination_gaps)

TODAY = dt.date(2025, 6, 30)


def day(n):
    return TODAY + dt.timedelta(days=n)


def depts(make):
    return make("departments", [
        {"DepartmentID": 1, "DepartmentName": "ER", "BedCapacity": 10},
        {"DepartmentID": 2, "DepartmentName": "ICU", "BedCapacity": None},
        {"DepartmentID": 3, "DepartmentName": "NICU", "BedCapacity": 0},
    ])


def test_low_stock_threshold_ties_and_nulls(make):
    sup = make("supplies", [
        {"SupplyID": 1, "SupplyName": "a", "DepartmentID": 1, "StockLevel": 5, "ReorderThreshold": 5},
        {"SupplyID": 2, "SupplyName": "b", "DepartmentID": 1, "StockLevel": 1, "ReorderThreshold": 9},
        {"SupplyID": 3, "SupplyName": "c", "DepartmentID": 2, "StockLevel": 2, "ReorderThreshold": 5},
        {"SupplyID": 4, "SupplyName": "d", "DepartmentID": 2, "StockLevel": 0, "ReorderThreshold": 3},
        {"SupplyID": 5, "SupplyName": "e", "DepartmentID": 1, "StockLevel": None, "ReorderThreshold": 3},
        {"SupplyID": 6, "SupplyName": "f", "DepartmentID": 9, "StockLevel": 0, "ReorderThreshold": 50},
    ])
    out = low_stock(sup, depts(make), n=2).collect()
    assert [r.SupplyName for r in out] == ["b", "c"]  # c and d tie at -3: lower id wins
    assert [r.SupplyName for r in low_stock(sup, depts(make), n=None).collect()] == ["b", "c", "d"]


def test_expiry_boundaries(make):
    sup = make("supplies", [
        {"SupplyID": i, "DepartmentID": 1, "ExpirationDate": e}
        for i, e in enumerate([day(-1), day(0), day(90), day(91), None])
    ])
    r = expiry_watch(sup, depts(make), as_of=TODAY).collect()
    assert [(x.DepartmentName, x.Expired, x.ExpiringSoon, x.TotalItems) for x in r] == [
        ("ER", 1, 2, 4)]


def test_inventory_value_exact(make):
    sup = make("supplies", [
        {"SupplyID": 1, "DepartmentID": 1, "StockLevel": 3, "UnitCost": 0.1},
        {"SupplyID": 2, "DepartmentID": 1, "StockLevel": 7, "UnitCost": 448.29},
        {"SupplyID": 3, "DepartmentID": 2, "StockLevel": None, "UnitCost": 1.0},
    ])
    assert rows(inventory_value(sup, depts(make)), "DepartmentName", "ItemCount", "TotalValue") == [
        ("ER", 2, 3138.33), ("ICU", 1, None)]


def test_complaints_vaccination_exposure(make):
    e = make("encounters", [
        {"EncounterID": 1, "DepartmentID": 3, "StaffID": 1, "ChiefComplaint": "Fever workup",
         "EncounterDate": day(0)},
        {"EncounterID": 2, "DepartmentID": 3, "StaffID": 2, "ChiefComplaint": "Fever workup",
         "EncounterDate": day(4)},
        {"EncounterID": 3, "DepartmentID": 1, "StaffID": 1, "ChiefComplaint": "wound infection",
         "EncounterDate": day(1)},
        {"EncounterID": 4, "DepartmentID": 1, "StaffID": 3, "ChiefComplaint": "GASTROENTERITIS",
         "EncounterDate": day(1)},
        {"EncounterID": 5, "DepartmentID": 1, "StaffID": 3, "ChiefComplaint": "ankle",
         "EncounterDate": day(1)},
    ])
    assert rows(complaint_clusters(e, 3), "ChiefComplaint", "CaseCount", "FirstCase", "LastCase") == [
        ("Fever workup", 2, day(0), day(4))]
    staff = make("staff", [
        {"StaffID": 1, "FirstName": "A", "LastName": "B", "Role": "nurse", "DepartmentID": 2,
         "VaxHBVStatus": None, "VaxTdapStatus": "complete"},
        {"StaffID": 2, "FirstName": "A", "LastName": "B", "Role": "nurse", "DepartmentID": 2,
         "VaxHBVStatus": "not immunized", "VaxTdapStatus": "incomplete"},
        {"StaffID": 3, "FirstName": "C", "LastName": "D", "Role": "resident", "DepartmentID": 1,
         "VaxHBVStatus": "complete", "VaxTdapStatus": "complete"},
    ])
    assert rows(vaccination_gaps(staff, depts(make)), "DepartmentName", "TotalStaff",
                "HBV_Incomplete", "Tdap_Incomplete") == [("ER", 1, 0, 0), ("ICU", 2, 1, 1)]
    # namesakes 1 and 2 merge; the department is the encounter's
    assert rows(infection_exposure(e, staff, depts(make)), "FirstName", "Role",
                "DepartmentName", "InfectionCases") == [
        ("A", "nurse", "ER", 1), ("A", "nurse", "NICU", 2), ("C", "resident", "ER", 1)]
    by_id = infection_exposure(e, staff, depts(make), by_id=True)
    assert by_id.where("DepartmentName = 'NICU'").count() == 2


def test_average_los_referrals_cost(make):
    e = make("encounters", [
        {"EncounterID": 1, "DepartmentID": 1, "EncounterType": "inpatient",
         "EncounterDate": day(0), "DischargeDate": day(0), "EncounterCost": 100.05},
        {"EncounterID": 2, "DepartmentID": 1, "EncounterType": "inpatient",
         "EncounterDate": day(0), "DischargeDate": day(3), "EncounterCost": 100.0},
        {"EncounterID": 3, "DepartmentID": 1, "EncounterType": "inpatient",
         "EncounterDate": day(0), "DischargeDate": None, "EncounterCost": None},
    ])
    assert rows(average_los(e, depts(make)), "DepartmentName", "Admissions", "AvgLOS") == [
        ("ER", 2, 1.5)]
    assert rows(cost_by_type(e), "EncounterType", "Total", "TotalCost", "AvgCost") == [
        ("inpatient", 3, 200.05, 100.03)]  # 100.025 rounds half up
    refs = make("referrals", [
        {"ReferralID": i, "ReceivingHospital": "X", "Status": s, "ReferralDirection": dirn}
        for i, (s, dirn) in enumerate([("rejected", "outgoing"), ("accepted", "outgoing"),
                                       ("pending", "outgoing"), ("rejected", "incoming")])
    ])
    assert rows(referral_rejection(refs), "ReceivingHospital", "TotalReferrals", "Rejected",
                "RejectionPct") == [("X", 3, 1, 33.3)]


def test_claims_reports(make):
    e = make("encounters", [
        {"EncounterID": 1, "DepartmentID": 1, "EncounterDate": day(0)},
        {"EncounterID": 2, "DepartmentID": 2, "EncounterDate": day(0)},
        {"EncounterID": 3, "DepartmentID": 2, "EncounterDate": None},
    ])
    claims = make("billing_claims", [dict(c, ClaimID=i) for i, c in enumerate(
        [{"EncounterID": 1, "ClaimStatus": "denied", "BilledAmount": 10.0, "DateSubmitted": day(2)}] * 4
        + [{"EncounterID": 2, "ClaimStatus": "denied", "BilledAmount": 1.5, "DateSubmitted": day(-1)}] * 2
        + [{"EncounterID": 2, "ClaimStatus": "paid", "BilledAmount": 2.25, "DateSubmitted": None}] * 2
        + [{"EncounterID": 3, "ClaimStatus": "paid", "BilledAmount": 2.0, "DateSubmitted": day(5)}]
        + [{"EncounterID": 99, "ClaimStatus": "paid", "BilledAmount": 2.0, "DateSubmitted": day(5)}])])
    # department with 4 claims is cut, with 5 kept
    assert rows(denial_rate(claims, e, depts(make)), "DepartmentName", "TotalClaims",
                "DeniedClaims", "DenialPct", "RevenueLost", "TotalBilled") == [
        ("ICU", 5, 2, 40.0, 3.0, 9.5)]
    assert rows(claim_lag(claims, e, depts(make)), "DepartmentName", "ClaimCount",
                "AvgDaysToSubmit") == [("ER", 4, 2.0), ("ICU", 5, -1.0)]


def test_satisfaction_gap(make):
    e = make("encounters", [{"EncounterID": 1, "DepartmentID": 1}])
    s = make("satisfaction_surveys", [
        {"SurveyID": 1, "EncounterID": 1, "StaffRating": 5, "FacilityRating": 2},
        {"SurveyID": 2, "EncounterID": 1, "StaffRating": 4, "FacilityRating": None},
        {"SurveyID": 3, "EncounterID": 1, "StaffRating": 4, "FacilityRating": 3},
    ])
    # staff 13/3 = 4.333, facility 5/2 = 2.5 -> gap 1.8333
    assert rows(satisfaction_gap(s, e, depts(make)), "DepartmentName", "Responses", "AvgStaff",
                "AvgFacility", "Gap") == [("ER", 3, 4.3, 2.5, 1.8)]


def test_costliest_stays_rank_ties(make):
    e = make("encounters", [
        {"EncounterID": i, "DepartmentID": 1, "EncounterType": t, "EncounterDate": day(0),
         "DischargeDate": day(los) if los is not None else None, "EncounterCost": c}
        for i, (t, los, c) in enumerate([
            ("inpatient", 2, 900.0), ("inpatient", 1, 900.0), ("inpatient", 3, 500.0),
            ("inpatient", 1, 400.0), ("inpatient", 0, 9999.0), ("emergency", 2, 9999.0),
            ("inpatient", None, 9999.0)])
    ])
    got = rows(costliest_stays(e, depts(make)), "EncounterID", "CostRank")
    assert got == [(0, 1), (1, 1), (2, 3)]


def test_chronic_complications_and_risk_tiers(make):
    pts = make("patients", [{"PatientID": p, "Zip": z} for p, z in
                            [(1, "12307"), (2, "12303"), (3, "12301"), (4, "12301"), (5, "00000")]])
    E = "inpatient"
    encs = [
        # patient 1: two complications -> High
        (1, 1, E, 0, 2, "Diabetes review", "Medicare", 100.0),
        (2, 1, "emergency", 10, 10, "asthma", "Medicaid", 200.0),
        # patient 2: one complication and a readmission -> High
        (3, 2, "outpatient", 0, 0, "hypertension", "Commercial", 50.0),
        (4, 2, "emergency", 3, 3, "HYPERTENSION check", "Commercial", 50.0),
        (5, 2, E, 40, 41, "ankle", "Commercial", 1.0),      # not chronic, prior stay
        (6, 2, "outpatient", 50, 50, "heart failure", "Commercial", 50.0),
        # patient 3: no complication, two denied claims -> Moderate
        (7, 3, "outpatient", 0, 0, "diabetic foot", "Medicare", 10.0),
        # patient 4: nothing -> Low, no claims
        (8, 4, "observation", 0, 0, "hypoglycemic", "Medicare", 10.0),
        # patient 5: unknown zip
        (9, 5, "outpatient", 0, 0, "asthma", "Uninsured", 1.0),
    ]
    df = make("encounters", [
        {"EncounterID": i, "PatientID": p, "EncounterType": t, "EncounterDate": day(s),
         "DischargeDate": day(x), "ChiefComplaint": c, "InsuranceType": ins, "EncounterCost": cost}
        for i, p, t, s, x, c, ins, cost in encs])
    claims = make("billing_claims", [
        {"ClaimID": 1, "EncounterID": 7, "ClaimStatus": "DENIED"},
        {"ClaimID": 2, "EncounterID": 7, "ClaimStatus": "denied"},
        {"ClaimID": 3, "EncounterID": 1, "ClaimStatus": "paid"}])
    tiers = {r.PatientID: r for r in risk_tiers(df, pts, claims).collect()}
    assert {p: r.RiskLevel for p, r in tiers.items()} == {
        1: "High", 2: "High", 3: "Moderate", 4: "Low", 5: "Low"}
    assert (tiers[2].ReadmissionCount, tiers[2].ComplicationCount, tiers[2].ChronicEncounters) == (1, 1, 3)
    assert (tiers[3].TotalClaims, tiers[3].DeniedClaims, tiers[4].TotalClaims) == (2, 2, 0)
    assert tiers[1].InsuranceType == "Medicare" and tiers[1].AvgCost == 150.0
    assert [r.PatientID for r in risk_tiers(df, pts, claims).collect()][:2] == [1, 2]
    cc = rows(chronic_complications(df, pts), "CatchmentArea", "InsuranceType",
              "TotalEncounters", "Complications", "ComplicationPct", "AvgCost")
    assert ("HSA-2", "Commercial", 3, 1, 33.3, 50.0) in cc
    assert ("Unassigned", "Uninsured", 1, 0, 0.0, 1.0) in cc


def test_rank_tie_at_the_cut_keeps_both(make):
    e = make("encounters", [
        {"EncounterID": i, "DepartmentID": 1, "EncounterType": "inpatient",
         "EncounterDate": day(0), "DischargeDate": day(1), "EncounterCost": c}
        for i, c in enumerate([900.0, 800.0, 700.0, 700.0, 600.0])])
    assert rows(costliest_stays(e, depts(make)), "EncounterID", "CostRank") == [
        (0, 1), (1, 2), (2, 3), (3, 3)]


def test_single_complication_is_moderate_and_keyword_inside_word(make):
    pts = make("patients", [{"PatientID": 1, "Zip": "12301"}])
    df = make("encounters", [
        {"EncounterID": 1, "PatientID": 1, "EncounterType": "emergency", "EncounterDate": day(0),
         "DischargeDate": day(0), "ChiefComplaint": "prediabetic check", "EncounterCost": 1.0},
        {"EncounterID": 2, "PatientID": 1, "EncounterType": "outpatient", "EncounterDate": day(90),
         "DischargeDate": day(90), "ChiefComplaint": "Asthmatic", "EncounterCost": 2.0}])
    claims = make("billing_claims", [{"ClaimID": 1, "EncounterID": 1, "ClaimStatus": "paid"}])
    r = risk_tiers(df, pts, claims).collect()
    assert [(x.ChronicEncounters, x.ComplicationCount, x.ReadmissionCount, x.RiskLevel,
             x.AvgCost) for x in r] == [(2, 1, 0, "Moderate", 1.5)]
    staff = make("staff", [{"StaffID": 1, "FirstName": "A", "LastName": "B", "Role": "nurse"}])
    e = make("encounters", [{"EncounterID": 1, "StaffID": 1, "DepartmentID": 1,
                             "ChiefComplaint": "reinfection"}])
    assert rows(infection_exposure(e, staff, depts(make)), "InfectionCases") == [(1,)]
