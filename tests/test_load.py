"""Loads with a quarantine: every row goes one way, with all its reasons."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from tests.conftest import fresh
from wardlens.sources.load import TooManyRejects, load_table, read_loaded, read_rejects

CSV = """EncounterID,ClaimID,BilledAmount,AllowedAmount,PaidAmount,ClaimStatus,DateSubmitted,Extra
1,10,100.5,,90,paid,2024-01-02,x
2,11,abc,1,1,denied,2024-02-30,x
,12, 7 ,1,1,,,x
3,,5,1,1,paid,2024-01-02,x
4,13,1e3,1,1,a status that is far too long to fit,2024-01-02,x
x,y,z,1,1,paid,soon,x
5,99999999999999999999,1,1,1,paid,2024-01-02,x
"""


def _write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return f"file:{tmp_path}/{name}"


def test_csv_splits_good_rows_from_rejects(spark, tmp_path):
    root = fresh(spark, "test-load-csv")
    path = _write(tmp_path, "claims.csv", CSV)
    with pytest.raises(TooManyRejects, match="5 of 7 rows.*BilledAmount is no double"):
        load_table(spark, path, "billing_claims", root, max_reject_share=0.5, part="a")
    assert read_loaded(spark, root, "billing_claims").count() == 0
    done = load_table(spark, path, "billing_claims", root, max_reject_share=0.8, part="a")
    assert (done.rows_in, done.rows_out, done.rejects) == (7, 2, 5)
    good = sorted(tuple(r) for r in read_loaded(spark, root, "billing_claims").collect())
    assert good == [(10, 1, 100.5, None, 90.0, "paid", dt.date(2024, 1, 2)),
                    (12, None, 7.0, 1.0, 1.0, None, None)]
    bad = {r.Row["EncounterID"]: r for r in read_rejects(spark, root, "billing_claims").collect()}
    assert {k: v.Reasons for k, v in bad.items()} == {
        "2": ["BilledAmount is no double", "DateSubmitted is no date"],
        "3": ["ClaimID is missing"],
        "4": ["ClaimStatus is longer than 20"],
        "x": ["ClaimID is no bigint", "EncounterID is no bigint", "BilledAmount is no double",
              "DateSubmitted is no date"],
        "5": ["ClaimID is no bigint"]}
    assert bad["2"].Row["BilledAmount"] == "abc" and bad["2"].File.endswith("claims.csv")
    # The same part again: still one copy; another part adds to it.
    load_table(spark, path, "billing_claims", root, max_reject_share=0.8, part="a")
    assert read_loaded(spark, root, "billing_claims").count() == 2
    assert read_rejects(spark, root, "billing_claims").count() == 5
    load_table(spark, path, "billing_claims", root, max_reject_share=0.8, part="b")
    assert read_loaded(spark, root, "billing_claims").count() == 4


def test_json_lines_and_broken_records(spark, tmp_path):
    root = fresh(spark, "test-load-json")
    lines = [json.dumps({"SupplyID": i, "SupplyName": "s" * (99 + i), "UnitCost": "2.5",
                         "ControlledItem": t, "ExpirationDate": "2024-01-01"})
             for i, t in ((1, "true"), (2, "false"), (3, "perhaps"))]
    path = _write(tmp_path, "supplies.json", "\n".join([*lines, '{"SupplyID": 4, "Suppl']))
    done = load_table(spark, path, "supplies", root, fmt="json", max_reject_share=1.0)
    assert (done.rows_in, done.rows_out, done.rejects) == (4, 1, 3)
    reasons = sorted(r.Reasons for r in read_rejects(spark, root, "supplies").collect())
    assert reasons == [["SupplyName is longer than 100"],
                       ["SupplyName is longer than 100", "ControlledItem is no boolean"],
                       ["not a record", "SupplyID is missing"]]
    row = read_loaded(spark, root, "supplies").first()
    assert (row.SupplyID, row.UnitCost, row.ControlledItem) == (1, 2.5, True)


def test_missing_column_and_empty_file(spark, tmp_path):
    root = fresh(spark, "test-load-odd")
    with pytest.raises(ValueError, match="no column EncounterID"):
        load_table(spark, _write(tmp_path, "bad.csv", "ClaimID\n1\n"), "billing_claims", root)
    header = CSV.splitlines()[0] + "\n"
    done = load_table(spark, _write(tmp_path, "none.csv", header), "billing_claims", root)
    assert (done.rows_in, done.rejects) == (0, 0)
    assert read_loaded(spark, root, "billing_claims").count() == 0
