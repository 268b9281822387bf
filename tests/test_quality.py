from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import rows
from wardlens.operators import (duplicate_keys, foreign_key_report, key_report, length_report,
                                length_violations, not_null_report, null_violations,
                                orphans)
from wardlens.sources.model import Tables


def test_duplicate_and_null_keys(make):
    sup = make("supplies", [
        {"SupplyID": 1, "DepartmentID": 1, "SupplyName": "Gauze"},
        {"SupplyID": 2, "DepartmentID": 1, "SupplyName": "gauze"},
        {"SupplyID": 3, "DepartmentID": 2, "SupplyName": "gauze"},
        {"SupplyID": 3, "DepartmentID": None, "SupplyName": "tape"},
    ])
    assert rows(duplicate_keys(sup, ["SupplyID"])) == [(3, 2)]
    uniq = duplicate_keys(sup, ["DepartmentID", F.lower("SupplyName").alias("SupplyName")],
                          nulls_are_violations=False)
    assert rows(uniq) == [(1, "gauze", 2)]
    pk = duplicate_keys(sup, ["DepartmentID", "SupplyID"])
    assert rows(pk) == [(None, 3, 1)]


def test_orphans_and_foreign_key_report(make):
    deps = make("departments", [{"DepartmentID": 1, "DepartmentName": "A"}])
    staff = make("staff", [{"StaffID": 1, "DepartmentID": 1}, {"StaffID": 2, "DepartmentID": 7},
                           {"StaffID": 3, "DepartmentID": None}])
    assert rows(orphans(staff, deps, "DepartmentID"), "StaffID") == [(2,)]
    rep = foreign_key_report(Tables(departments=deps, staff=staff))
    assert rows(rep) == [("staff", "DepartmentID", "departments", 1)]


def test_nulls_and_lengths(make):
    deps = make("departments", [{"DepartmentID": 1, "DepartmentName": "x" * 51},
                                {"DepartmentID": 2, "DepartmentName": "ok",
                                 "PhoneExtension": "12345678901"}])
    assert rows(null_violations(deps, ["DepartmentName", "PhoneExtension"])) == [
        ("DepartmentName", 0), ("PhoneExtension", 1)]
    lv = rows(length_violations(deps, {"DepartmentName": 50, "PhoneExtension": 10}))
    assert lv == [("DepartmentName", 50, 1, 51), ("PhoneExtension", 10, 1, 11)]
    t = Tables(departments=deps)
    assert rows(not_null_report(t)) == [("departments", "DepartmentID", 0),
                                        ("departments", "DepartmentName", 0)]
    assert ("departments", "DepartmentName", 50, 1, 51) in rows(length_report(t))


def test_key_report(make):
    sup = make("supplies", [
        {"SupplyID": 1, "DepartmentID": 1, "SupplyName": "Gauze"},
        {"SupplyID": 1, "DepartmentID": 1, "SupplyName": "gauze"},
        {"SupplyID": 3, "DepartmentID": 2, "SupplyName": None},
    ])
    deps = make("departments", [{"DepartmentID": 1, "DepartmentName": "A"}])
    rep = rows(key_report(Tables(supplies=sup, departments=deps)))
    assert rep == [("departments", "DepartmentID", "primary", 0, 0),
                   ("supplies", "DepartmentID, SupplyName", "unique", 1, 0),
                   ("supplies", "SupplyID", "primary", 1, 0)]
