"""The adapter reproduces the facts recorded for the sf0.01 benchmark tables
(SURVEY §7.4), and the model readers round-trip with declared schemas."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardlens import schemas
from wardlens.operators import risk_tiers, with_catchment_area, with_readmission_flag
from wardlens.session import shared_dir
from wardlens.sources import driver_tables, read_tables, write_tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def t(spark):
    if not os.path.exists(SF):
        pytest.skip("benchmark tables missing")
    return driver_tables(spark, SF)


def test_encounter_facts(t):
    e = t.encounters
    assert dict(rows(e.groupBy("EncounterType").count())) == {
        "outpatient": 5999, "observation": 3020, "inpatient": 3003, "emergency": 2978}
    assert e.where("EncounterType = 'inpatient' AND DischargeDate IS NOT NULL").count() == 1965
    assert with_readmission_flag(e).where("IsReadmission = 'Yes'").count() == 250


def test_supply_and_claim_facts(t):
    s = t.supplies
    assert s.where("StockLevel < ReorderThreshold").count() == 1108
    as_of = F.lit(dt.date(2025, 6, 30))
    assert s.where(F.col("ExpirationDate") < as_of).count() == 600
    assert s.where(F.col("ExpirationDate").between(as_of, F.date_add(as_of, 90))).count() == 303
    assert t.billing_claims.where("ClaimStatus = 'denied'").count() == 20046


def test_risk_tier_facts(t):
    rt = risk_tiers(t.encounters, t.patients, t.billing_claims, n=None)
    assert dict(rows(rt.groupBy("RiskLevel").count())) == {"High": 905, "Moderate": 561,
                                                           "Low": 26}
    assert rt.where("ComplicationCount = 1 AND ReadmissionCount >= 1").count() == 15


def test_schemas_are_declared(t):
    for name in t.names():
        assert getattr(t, name).schema.fieldNames() == schemas.MODEL[name].fieldNames()


def test_write_and_read_tables(spark, make):
    root = shared_dir(spark, "test-sources")
    deps = make("departments", [{"DepartmentID": 1, "DepartmentName": "A", "BedCapacity": 3},
                                {"DepartmentID": 2, "DepartmentName": "B, C"}])
    from wardlens.sources.model import Tables
    write_tables(Tables(departments=deps), root)
    back = read_tables(spark, root, names=["departments"])
    assert back.departments.schema == schemas.DEPARTMENTS or \
        back.departments.schema.fieldNames() == schemas.DEPARTMENTS.fieldNames()
    assert rows(back.departments, "DepartmentID", "DepartmentName", "BedCapacity") == [
        (1, "A", 3), (2, "B, C", None)]
    deps.write.mode("overwrite").option("header", "true").csv(f"{root}/csv/departments")
    csv = read_tables(spark, f"{root}/csv", fmt="csv", names=["departments"])
    assert rows(csv.departments, "DepartmentID", "DepartmentName", "BedCapacity") == [
        (1, "A", 3), (2, "B, C", None)]


def test_catchment_mapping_table(spark, make):
    pts = make("patients", [{"PatientID": 1, "Zip": "12307"}, {"PatientID": 2, "Zip": "55555"},
                            {"PatientID": 3, "Zip": None}])
    m = spark.createDataFrame([("12307", "North"), ("55555", "South")], "Zip string, CatchmentArea string")
    assert rows(with_catchment_area(pts, m), "PatientID", "CatchmentArea") == [
        (1, "North"), (2, "South"), (3, "Unassigned")]


def test_derived_model_gives_the_same_reports(spark, t):
    """Reports over materialised derived columns (stored flag, stored LOS,
    stored area) equal the reports that derive them on the fly."""
    from wardlens.operators import derive_model
    from wardlens.plans import compute_indicators
    d = derive_model(t, materialize_to=shared_dir(spark, "test-derived"))
    assert {"IsReadmission", "LengthOfStayDays"} <= set(d.encounters.columns)
    assert "CatchmentArea" in d.patients.columns
    a = rows(risk_tiers(d.encounters, d.patients, d.billing_claims, n=None))
    b = rows(risk_tiers(t.encounters, t.patients, t.billing_claims, n=None))
    assert a == b
    s, e = dt.date(1996, 1, 1), dt.date(1997, 12, 31)
    assert rows(compute_indicators(d, s, e, dt.date(2026, 5, 15))) == \
        rows(compute_indicators(t, s, e, dt.date(2026, 5, 15)))


def test_clustered_write_lets_period_filters_skip_files(spark, t):
    import contextlib
    import io
    from wardlens.sources.model import Tables
    root = shared_dir(spark, "test-cluster")
    write_tables(Tables(encounters=t.encounters), root,
                 cluster_by={"encounters": "EncounterDate"}, files={"encounters": 8})
    back = read_tables(spark, root, names=["encounters"]).encounters
    assert back.count() == t.encounters.count()
    q = back.where(F.col("EncounterDate").between(dt.date(1996, 1, 1), dt.date(1996, 3, 31)))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    assert "GreaterThanOrEqual(EncounterDate,1996-01-01)" in buf.getvalue()
    files = spark.read.parquet(f"{root}/encounters").select(F.input_file_name()).distinct()
    hit = q.select(F.input_file_name()).distinct().count()
    assert 0 < hit < files.count()


def test_indicators_from_a_materialised_period_slice(spark, t):
    from wardlens.plans import compute_indicators
    s, e, on = dt.date(1996, 1, 1), dt.date(1997, 12, 31), dt.date(2026, 5, 15)
    a = compute_indicators(t, s, e, on, materialize_to=shared_dir(spark, "test-slice"))
    assert rows(a) == rows(compute_indicators(t, s, e, on))


def test_bucketed_model_joins_without_shuffling_the_big_sides(spark, t):
    import contextlib
    import io
    from wardlens.operators import claim_lag, denial_rate
    from wardlens.sources import read_catalog, save_bucketed
    db = "wardlens_bucketed_test"
    save_bucketed(t, db, buckets=8, location=shared_dir(spark, "test-bucketed"))
    b = read_catalog(spark, db)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = claim_lag(b.billing_claims, b.encounters, b.departments)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q.explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan and "EncounterID" in plan
        assert "Exchange hashpartitioning(EncounterID" not in plan
        assert rows(q) == rows(claim_lag(t.billing_claims, t.encounters, t.departments))
        assert rows(denial_rate(b.billing_claims, b.encounters, b.departments)) == \
            rows(denial_rate(t.billing_claims, t.encounters, t.departments))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_read_tables_missing_ok(spark, make):
    from pyspark.errors import AnalysisException
    from wardlens.sources.model import Tables
    root = shared_dir(spark, "test-missing")
    write_tables(Tables(departments=make("departments", [{"DepartmentID": 1,
                                                          "DepartmentName": "A"}])), root)
    with pytest.warns(UserWarning, match="table patients is missing"):
        t = read_tables(spark, root, missing_ok=True)
    assert t.names() == ["departments"]
    with pytest.raises(AnalysisException):
        read_tables(spark, root)


def test_with_derived_keeps_only_stored_columns(spark, make):
    from wardlens.sources.model import Tables
    root = shared_dir(spark, "test-with-derived")
    enc = make("encounters", [{"EncounterID": 1, "PatientID": 1}])
    write_tables(Tables(encounters=enc), f"{root}/plain")
    write_tables(Tables(encounters=enc.withColumn("IsReadmission", F.lit("Yes"))),
                 f"{root}/stored")
    plain = read_tables(spark, f"{root}/plain", names=["encounters"], with_derived=True)
    stored = read_tables(spark, f"{root}/stored", names=["encounters"], with_derived=True)
    assert "IsReadmission" not in plain.encounters.columns
    assert stored.encounters.select("IsReadmission").first()[0] == "Yes"
    assert "LengthOfStayDays" not in stored.encounters.columns


def test_csv_is_read_by_header_name(spark):
    root = shared_dir(spark, "test-csv-names")
    frame = spark.createDataFrame([("Doe", "x", 7, "Ann", "1990-02-03", "f", "a", "12301")],
                                  "LastName string, Other string, PatientID long, FirstName string, "
                                  "DOB string, Sex string, Address string, Zip string")
    frame.write.mode("overwrite").option("header", True).csv(f"{root}/patients")
    row = read_tables(spark, root, "csv", names=["patients"]).patients.first()
    assert (row.PatientID, row.FirstName, row.LastName) == (7, "Ann", "Doe")
    assert row.DOB.isoformat() == "1990-02-03"
    frame.drop("Zip").write.mode("overwrite").option("header", True).csv(f"{root}/patients")
    with pytest.raises(ValueError, match="no column Zip"):
        read_tables(spark, root, "csv", names=["patients"])


@pytest.mark.parametrize("fmt", ["json", "csv", "orc"])
def test_derived_columns_must_be_in_the_files(spark, make, fmt):
    root = shared_dir(spark, f"test-derived-{fmt}")
    enc = make("encounters", [{"EncounterID": 1, "PatientID": 1, "EncounterType": "inpatient"}])
    for name, frame in (("plain", enc), ("stored", enc.withColumn("IsReadmission", F.lit("Yes")))):
        w = frame.write.mode("overwrite").format(fmt)
        (w.option("header", True) if fmt == "csv" else w).save(f"{root}/{name}/encounters")
    read = {n: read_tables(spark, f"{root}/{n}", fmt, names=["encounters"], with_derived=True).encounters
            for n in ("plain", "stored")}
    assert "IsReadmission" not in read["plain"].columns
    assert read["stored"].select("IsReadmission").first()[0] == "Yes"


def test_read_jdbc_needs_bounds(spark):
    from wardlens.sources.model import read_jdbc
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:example://host/model", "departments", {}, partition_column="DepartmentID")


def test_read_jdbc_builds_a_partitioned_read(spark, make):
    """No database may run here: a stand-in reader records the options and
    returns a frame, which is then conformed to the declared schema."""
    from wardlens.sources.model import read_jdbc

    recorded = {}
    frame = make("departments", [{"DepartmentID": 1, "DepartmentName": "A"}]).drop("Building")

    class Reader:
        def format(self, f):
            recorded["format"] = f
            return self

        def option(self, k, v):
            recorded[k] = v
            return self

        def load(self):
            return frame

    class Fake:
        read = Reader()

    df = read_jdbc(Fake(), "jdbc:example://host/model", "departments", {"user": "u"},
                   partition_column="DepartmentID", lower=1, upper=1000, num_partitions=16)
    assert recorded == {"format": "jdbc", "url": "jdbc:example://host/model",
                        "dbtable": "departments", "user": "u",
                        "partitionColumn": "DepartmentID", "lowerBound": "1",
                        "upperBound": "1000", "numPartitions": "16"}
    assert df.columns == schemas.MODEL["departments"].fieldNames()
    assert df.first().Building is None
