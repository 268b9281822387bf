"""Adapter: the benchmark's generic tables → the nine model tables.

The benchmark ships TPC-H-like tables (``nation customer supplier part orders
lineitem events region``). The model is derived from them by fixed rules so
every report runs over whole tables and grows with them. All rules are plain
column expressions (Catalyst prunes unused columns down to the scans); the same
rules are written as SQL for the DuckDB oracle in ``wardlens.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens import schemas
from wardlens.sources.model import Tables, conform

# Fixed values of the adapter (its own design, not taken from the source).
COMPLAINTS = ["Fever since monday", "mild gastroenteritis", "Skin infection",
              "Type 2 diabetes review", "HYPERTENSION check", "asthma, night cough",
              "Heart failure review", "twisted ankle"]
INSURANCE = ["Medicare", "Medicaid", "Commercial"]
ROLES = ["nurse", "resident", "specialist", "consultant", "pharmacist", "technician"]
EXPIRY_BASE = dt.date(2025, 1, 1)
SUPPLY_AS_OF = dt.date(2025, 6, 30)
N_DEPARTMENTS = 25

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], idx) -> F.Column:
    """``values[idx]`` for a 0-based integral column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def departments(nation: DataFrame) -> DataFrame:
    beds = F.when(F.col("n_regionkey") == 4, F.lit(None)).otherwise(
        5 + F.col("n_nationkey") % 15)
    return conform(nation.select(
        F.col("n_nationkey").alias("DepartmentID"),
        F.col("n_name").alias("DepartmentName"),
        F.when(beds.isNull(), "support").otherwise("clinical").alias("DepartmentType"),
        beds.alias("BedCapacity"),
        F.lit("active").alias("OperationalStatus"),
    ), schemas.DEPARTMENTS)


def patients(customer: DataFrame) -> DataFrame:
    return conform(customer.select(
        F.col("c_custkey").alias("PatientID"),
        F.col("c_name").alias("LastName"),
        F.concat(F.lit("1230"), (1 + F.col("c_custkey") % 9).cast("string")).alias("Zip"),
    ), schemas.PATIENTS)


def staff(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return conform(supplier.select(
        k.alias("StaffID"),
        F.lit("Staff").alias("FirstName"),
        F.concat(F.lit("S"), (k % 50).cast("string")).alias("LastName"),
        _pick(ROLES, k % 6).alias("Role"),
        F.col("s_nationkey").alias("DepartmentID"),
        F.when(k % 10 == 9, "terminated").when(k % 10 == 8, "on leave")
         .otherwise("active").alias("EmploymentStatus"),
        F.when(k % 5 == 0, "incomplete").when(k % 5 == 1, "not immunized")
         .when(k % 5 == 2, F.lit(None)).otherwise("complete").alias("VaxHBVStatus"),
        F.when(k % 7 == 0, "incomplete").when(k % 7 == 1, F.lit(None))
         .otherwise("complete").alias("VaxTdapStatus"),
    ), schemas.STAFF)


def encounters(orders: DataFrame, supplier: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    n_staff = supplier.select(F.count(F.lit(1))).scalar()  # scalar subquery
    pri = F.substring("o_orderpriority", 1, 1)
    etype = (F.when(pri == "1", "emergency").when(pri == "2", "inpatient")
              .when(pri == "4", "observation").otherwise("outpatient"))
    day = F.col("o_orderdate").cast("date")
    discharge = (F.when(etype != "inpatient", day)
                  .when(F.col("o_orderstatus") == "P", F.lit(None).cast("date"))
                  .otherwise(F.date_add(day, (k % 11).cast("int"))))
    return conform(orders.select(
        k.alias("EncounterID"),
        F.col("o_custkey").alias("PatientID"),
        (k % N_DEPARTMENTS).alias("DepartmentID"),
        (k % n_staff).alias("StaffID"),
        etype.alias("EncounterType"),
        day.alias("EncounterDate"),
        discharge.alias("DischargeDate"),
        _pick(COMPLAINTS, k % 8).alias("ChiefComplaint"),
        _pick(INSURANCE, k % 3).alias("InsuranceType"),
        F.col("o_totalprice").alias("EncounterCost"),
    ), schemas.ENCOUNTERS)


def billing_claims(lineitem: DataFrame) -> DataFrame:
    rf = F.col("l_returnflag")
    return conform(lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ClaimID"),
        F.col("l_orderkey").alias("EncounterID"),
        F.col("l_extendedprice").alias("BilledAmount"),
        F.when(rf == "R", "denied").when(rf == "A", "paid").when(rf == "N", "pending")
         .alias("ClaimStatus"),
        F.col("l_shipdate").cast("date").alias("DateSubmitted"),
    ), schemas.BILLING_CLAIMS)


def supplies(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    expiry = F.when(k % 3 == 0, F.lit(None).cast("date")).otherwise(
        F.date_add(F.lit(EXPIRY_BASE), (k % 400).cast("int")))
    return conform(part.select(
        k.alias("SupplyID"),
        F.col("p_name").alias("SupplyName"),
        F.col("p_type").alias("Category"),
        (k % N_DEPARTMENTS).alias("DepartmentID"),
        F.col("p_size").alias("StockLevel"),
        (k % 60).alias("ReorderThreshold"),
        expiry.alias("ExpirationDate"),
        F.col("p_retailprice").alias("UnitCost"),
    ), schemas.SUPPLIES)


def satisfaction_surveys(events: DataFrame) -> DataFrame:
    return conform(events.select(
        F.col("event_id").alias("SurveyID"),
        F.col("user_id").alias("PatientID"),
        F.col("event_id").alias("EncounterID"),
        (1 + F.col("event_id") % 4).alias("StaffRating"),
        (1 + F.col("user_id") % 5).alias("FacilityRating"),
        F.col("ts").cast("date").alias("SurveyDate"),
    ), schemas.SATISFACTION_SURVEYS)


def referrals(events: DataFrame, region: DataFrame) -> DataFrame:
    et = F.col("event_type")
    ev = events.withColumn("_region", (F.col("event_id") % 5).cast("int"))
    # ``region`` has five rows at every scale factor: a fixed, proven bound.
    reg = F.broadcast(region.select(F.col("r_regionkey").alias("_region"),
                                    F.col("r_name").alias("ReceivingHospital")))
    return conform(ev.join(reg, "_region", "left").select(
        F.col("event_id").alias("ReferralID"),
        F.col("user_id").alias("PatientID"),
        F.col("event_id").alias("EncounterID"),
        (F.col("event_id") % N_DEPARTMENTS).alias("DepartmentID"),
        F.col("ReceivingHospital"),
        F.col("ts").cast("date").alias("DateRequested"),
        F.when(et == "error", "rejected").when(et.isin("view", "click"), "accepted")
         .otherwise("pending").alias("Status"),
        F.when(F.col("event_id") % 3 == 0, "incoming").otherwise("outgoing")
         .alias("ReferralDirection"),
    ), schemas.REFERRALS)


def driver_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The base model tables, lazily derived from the benchmark tables."""
    r = lambda n: read_driver(spark, sf_dir, n)
    supplier = r("supplier")
    events = r("events")
    return Tables(
        departments=departments(r("nation")),
        patients=patients(r("customer")),
        staff=staff(supplier),
        supplies=supplies(r("part")),
        encounters=encounters(r("orders"), supplier),
        referrals=referrals(events, r("region")),
        billing_claims=billing_claims(r("lineitem")),
        satisfaction_surveys=satisfaction_surveys(events),
    )
