"""Collated text against folding by hand."""

from __future__ import annotations

import datetime as dt
import random
import unicodedata
from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import fresh, rows
from wardlens.functions.collation import collated, collated_schema, plain, with_collation
from wardlens.functions.columns import contains_any
from wardlens.operators import (complaint_clusters, denial_rate, duplicate_keys, orphans,
                                referral_rejection)
from wardlens.sources.model import Tables

SPELLINGS = ["denied", "Denied", "DÉNIED", "dénied", "paid", "Paid", None, "denied "]


def fold(text):
    if text is None:
        return None
    bare = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    return bare.casefold()


def test_equality_grouping_and_lists(spark, make):
    rng = random.Random(2)
    refs = [{"ReferralID": i, "ReceivingHospital": rng.choice(["Åbo", "abo", "ABO", "Basel", None]),
             "Status": rng.choice(["rejected", "REJECTED", "réjected", "open"]),
             "ReferralDirection": rng.choice(["outgoing", "Outgoing", "OUTGOING", "incoming"])}
            for i in range(200)]
    want = {}
    for r in refs:
        if fold(r["ReferralDirection"]) == "outgoing":
            n = want.setdefault(fold(r["ReceivingHospital"]), [0, 0])
            n[0] += 1
            n[1] += fold(r["Status"]) == "rejected"
    got = plain(referral_rejection(collated(make("referrals", refs)))).collect()
    assert {fold(r.ReceivingHospital): [r.TotalReferrals, r.Rejected] for r in got} == want
    assert len(got) == len(want) == 3 and dict(plain(collated(make("referrals", refs))).dtypes) == dict(
        make("referrals", refs).dtypes)

    claims = [{"ClaimID": i, "EncounterID": 1, "ClaimStatus": s, "BilledAmount": 1.0}
              for i, s in enumerate(SPELLINGS)]
    t = with_collation(Tables(
        billing_claims=make("billing_claims", claims),
        encounters=make("encounters", [{"EncounterID": 1, "DepartmentID": 1}]),
        departments=make("departments", [{"DepartmentID": 1, "DepartmentName": "A"}])))
    r = denial_rate(t.billing_claims, t.encounters, t.departments).first()
    assert (r.TotalClaims, r.DeniedClaims, r.RevenueLost) == (8, sum(fold(s) == "denied" for s in SPELLINGS), 4.0)


def test_clusters_keys_and_joins(spark, make):
    complaints = ["Fièvre", "fievre", "FIÈVRE", "Toux", "toux", None]
    enc = [{"EncounterID": i, "DepartmentID": 3, "ChiefComplaint": c,
            "EncounterDate": dt.date(2024, 1, 1 + i)} for i, c in enumerate(complaints)]
    got = {fold(r[0]): r[1:] for r in complaint_clusters(collated(make("encounters", enc))).collect()}
    assert got == {"fievre": (3, dt.date(2024, 1, 1), dt.date(2024, 1, 3)),
                   "toux": (2, dt.date(2024, 1, 4), dt.date(2024, 1, 5)),
                   None: (1, dt.date(2024, 1, 6), dt.date(2024, 1, 6))}
    names = ["Gaze", "GAZÉ", "gaze", "Bande", "bande"]
    sup = collated(make("supplies", [{"SupplyID": i, "DepartmentID": 1, "SupplyName": n}
                                     for i, n in enumerate(names)]))
    twice = {fold(r.SupplyName): r.Occurrences for r in duplicate_keys(sup, ["DepartmentID", "SupplyName"]).collect()}
    assert twice == {k: n for k, n in Counter(map(fold, names)).items() if n > 1}
    left = collated(spark.createDataFrame([("Zürich",), ("bern",), ("Genf",)], "city string"))
    right = collated(spark.createDataFrame([("zurich",), ("BERN",)], "city string"))
    assert rows(plain(orphans(left, right, "city"))) == [("Genf",)]


def test_words_are_found_without_case_and_accents(spark):
    texts = ["Fever", "FÉVER workup", "féver", "réinfection", "Infectiön", "none", "", None, "50% off", "5_x"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for df in (frame, collated(frame)):
        found = [r.t for r in df.where(contains_any("t", ["fever", "infection"])).collect()]
        assert found == [t for t in texts if t and any(w in fold(t) for w in ("fever", "infection"))]
        assert [r.t for r in df.where(contains_any("t", ["0%", "5_"])).collect()] == ["50% off", "5_x"]


def test_collated_schema_reads_plain_files(spark, make):
    path = fresh(spark, "test-collation")
    make("billing_claims", [{"ClaimID": i, "ClaimStatus": s} for i, s in enumerate(SPELLINGS)]).write.parquet(path)
    read = spark.read.schema(collated_schema("billing_claims")).parquet(path)
    assert read.where(F.col("ClaimStatus") == "DENIED").count() == 4
    assert read.where(F.col("ClaimStatus").isin("DENIED", "paid")).count() == 6
