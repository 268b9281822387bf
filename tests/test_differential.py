"""Differential test: every registered query, Spark against the SQL oracle, on
generated model tables full of the cases the benchmark data lacks — nulls in
every nullable column, mixed-case text, namesakes, orphan keys, zero and
missing bed capacities, dates on both sides of the reporting period and of the
expiry horizon. Both engines read the same Parquet files."""

from __future__ import annotations

import datetime as dt
import decimal
import random

import duckdb
import pytest

from wardlens import schemas
from wardlens.plans.catalog import MODEL_QUERIES
from wardlens.plans.oracle import model_sql
from wardlens.session import shared_dir
from wardlens.sources import read_tables

COMPLAINTS = ["Fever workup", "fever", "FEVER and chills", "Infection of wound",
              "gastroenteritis", "Type 2 Diabetes", "diabetic foot", "hypoglycemic episode",
              "Hypertension", "asthma attack", "Heart Failure", "ankle sprain",
              "100% better", "reinfection", None]
TYPES = ["inpatient", "inpatient", "outpatient", "emergency", "observation", None]
INSURANCE = ["Medicare", "Medicaid", "Commercial", "Self-Pay", None]
ROLES = ["nurse", "resident", "specialist", "consultant", "pharmacist", "technician", None]
EMPLOYMENT = ["active", "active", "on leave", "terminated", None]
VAX = ["complete", "complete", "incomplete", "not immunized", None]
CLAIM = ["paid", "denied", "DENIED", "pending", None]
SUPPLY_NAMES = ["Gauze", "gauze", "Saline", "Syringe", "Gloves", "GLOVES", "Mask", None]


def _maybe(rng, value, p=0.1):
    return None if rng.random() < p else value


def _day(rng, lo: dt.date, hi: dt.date) -> dt.date:
    return lo + dt.timedelta(days=rng.randrange((hi - lo).days + 1))


def _price(rng, most):
    """Amounts with two to four decimals, half cents among them."""
    return rng.choice([round(rng.uniform(0.01, most), rng.choice([2, 3, 4])),
                       rng.randrange(int(most)) + rng.choice([0.005, 0.125, 0.375, 0.0049])])


def generate(seed: int) -> dict[str, list[dict]]:
    rng = random.Random(seed)
    lo, hi = dt.date(1995, 11, 15), dt.date(1998, 2, 15)
    t: dict[str, list[dict]] = {}
    t["departments"] = [
        {"DepartmentID": i, "DepartmentName": f"Dept {i}",
         "BedCapacity": rng.choice([None, 0, rng.randrange(1, 30)])} for i in range(1, 8)]
    t["patients"] = [
        {"PatientID": i, "Zip": _maybe(rng, f"1230{rng.randrange(1, 10)}")}
        for i in range(1, 61)]
    t["staff"] = [
        {"StaffID": i, "FirstName": rng.choice(["Ann", "Bo"]),
         "LastName": rng.choice(["Lee", "Ng", "Diaz"]), "Role": rng.choice(ROLES),
         "DepartmentID": _maybe(rng, rng.randrange(1, 9)),
         "EmploymentStatus": rng.choice(EMPLOYMENT),
         "VaxHBVStatus": rng.choice(VAX), "VaxTdapStatus": rng.choice(VAX)}
        for i in range(1, 31)]
    t["supplies"] = [
        {"SupplyID": i, "SupplyName": rng.choice(SUPPLY_NAMES),
         "DepartmentID": _maybe(rng, rng.randrange(1, 9)),
         "StockLevel": _maybe(rng, rng.randrange(0, 40)),
         "ReorderThreshold": _maybe(rng, rng.randrange(0, 40)),
         "ExpirationDate": _maybe(rng, _day(rng, dt.date(2025, 2, 1), dt.date(2025, 11, 30)), 0.3),
         "UnitCost": _maybe(rng, _price(rng, 900))}
        for i in range(1, 81)]
    encs = []
    for i in range(1, 401):
        start = _maybe(rng, _day(rng, lo, hi), 0.03)
        etype = rng.choice(TYPES)
        stay = None if rng.random() < 0.15 else rng.randrange(0, 12)
        encs.append({
            "EncounterID": i, "PatientID": _maybe(rng, rng.randrange(1, 66), 0.05),
            "DepartmentID": _maybe(rng, rng.randrange(1, 9), 0.05),
            "StaffID": _maybe(rng, rng.randrange(1, 33), 0.05), "EncounterType": etype,
            "EncounterDate": start,
            "DischargeDate": None if start is None or stay is None
            else start + dt.timedelta(days=stay),
            "ChiefComplaint": rng.choice(COMPLAINTS), "InsuranceType": rng.choice(INSURANCE),
            "EncounterCost": _maybe(rng, _price(rng, 5000))})
    t["encounters"] = encs
    t["billing_claims"] = [
        {"ClaimID": i, "EncounterID": _maybe(rng, rng.randrange(1, 421), 0.05),
         "BilledAmount": _maybe(rng, _price(rng, 3000)),
         "ClaimStatus": rng.choice(CLAIM),
         "DateSubmitted": _maybe(rng, _day(rng, lo, hi))} for i in range(1, 701)]
    t["satisfaction_surveys"] = [
        {"SurveyID": i, "EncounterID": _maybe(rng, rng.randrange(1, 421), 0.05),
         "StaffRating": _maybe(rng, rng.randrange(1, 6)),
         "FacilityRating": _maybe(rng, rng.randrange(1, 6))} for i in range(1, 251)]
    t["referrals"] = [
        {"ReferralID": i, "ReceivingHospital": rng.choice(["North", "South", "East", None]),
         "Status": rng.choice(["accepted", "pending", "rejected", None]),
         "ReferralDirection": rng.choice(["outgoing", "outgoing", "incoming", None])}
        for i in range(1, 121)]
    return t


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("seed", [7, 2024])
def test_every_query_matches_sql_on_generated_data(spark, seed):
    root = shared_dir(spark, f"test-diff-{seed}")
    for name, data in generate(seed).items():
        schema = schemas.MODEL[name]
        rows_ = [tuple(r.get(f.name) for f in schema.fields) for r in data]
        spark.createDataFrame(rows_, schema).write.mode("overwrite").parquet(f"{root}/{name}")
    t = read_tables(spark, root)
    con = duckdb.connect()
    for name in schemas.MODEL:
        view = "patients_base" if name == "patients" else name
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{root}/{name}/*.parquet')")
    bad = []
    for name, fn in MODEL_QUERIES.items():
        df = fn(t)
        got = [tuple(r) for r in df.collect()]
        res = con.execute(model_sql(name))
        want = res.fetchall()
        cols = [d[0] for d in res.description]
        if sorted(df.columns) != sorted(cols) or _canon(df.columns, got) != _canon(cols, want):
            bad.append(name)
    assert not bad, bad
