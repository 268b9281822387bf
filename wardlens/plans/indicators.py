"""Quality indicators for a reporting period, and their report.

Four branches — readmission rate and first-encounter complication rate per
catchment area, bed utilisation and provider workload per department — are
computed lazily, united by name, classified by two cutoffs and stamped with the
period and the computation date. The period is validated on the driver before
any job starts.
"""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.fixed_values import (ACTIVE, CLINICAL_ROLES, COMPLICATION_TYPES,
                                   INDICATORS, INPATIENT, READMISSION_SCOPE)
from wardlens.functions.columns import date_id_order, in_period, severity
from wardlens.functions.exact import half_up_div, pct_half_up
from wardlens.operators.derive import (READMISSION_WINDOW_DAYS, readmission_day_counts,
                                       readmission_days, with_catchment_area,
                                       with_length_of_stay)
from wardlens.sources.model import Tables


@dataclass(frozen=True)
class Indicator:
    name: str
    critical: float
    elevated: float
    digits: int
    rule: str


READMISSION_RATE = Indicator(*INDICATORS["readmission_rate"])
FIRST_ENCOUNTER_COMPLICATION = Indicator(*INDICATORS["first_encounter_complication"])
BED_UTILIZATION = Indicator(*INDICATORS["bed_utilization"])
PROVIDER_WORKLOAD = Indicator(*INDICATORS["provider_workload"])

INDICATOR_COLUMNS = ["DepartmentID", "CatchmentArea", "IndicatorName",
                     "ReportingPeriodStart", "ReportingPeriodEnd", "Numerator",
                     "Denominator", "ComputedValue", "SeverityFlag",
                     "ComputationDate", "DerivationRule"]


def validate_period(start: dt.date | None, end: dt.date | None) -> int:
    """Raise ``ValueError('Invalid reporting period')`` for a missing date or
    start after end; return the number of days in the period (inclusive)."""
    if start is None or end is None or start > end:
        raise ValueError("Invalid reporting period")
    return (end - start).days + 1


def _finish(df: DataFrame, ind: Indicator, start: dt.date, end: dt.date,
            computed_on: dt.date | None) -> DataFrame:
    """Stamp a branch (DepartmentID, CatchmentArea, Numerator, Denominator,
    ComputedValue) into the 11 output columns."""
    return df.select(
        F.col("DepartmentID").cast("long").alias("DepartmentID"),
        F.col("CatchmentArea").cast("string").alias("CatchmentArea"),
        F.lit(ind.name).alias("IndicatorName"),
        F.lit(start).alias("ReportingPeriodStart"),
        F.lit(end).alias("ReportingPeriodEnd"),
        F.col("Numerator").cast("double").alias("Numerator"),
        F.col("Denominator").cast("double").alias("Denominator"),
        F.col("ComputedValue").cast("double").alias("ComputedValue"),
        severity("ComputedValue", ind.critical, ind.elevated).alias("SeverityFlag"),
        (F.lit(computed_on) if computed_on else F.current_date()).alias("ComputationDate"),
        F.lit(ind.rule).alias("DerivationRule"),
    )


def _areas(patients: DataFrame) -> DataFrame:
    p = patients if "CatchmentArea" in patients.columns else with_catchment_area(patients)
    return p.select("PatientID", "CatchmentArea")


def readmission_rate(encounters: DataFrame, patients: DataFrame, start: dt.date,
                     end: dt.date, computed_on: dt.date | None = None,
                     window_days: int = READMISSION_WINDOW_DAYS,
                     method: str = "bucketed") -> DataFrame:
    """Share of inpatient+emergency encounters in the period flagged as a
    readmission, per catchment area (cutoffs 10 / 5).

    Without a stored ``IsReadmission`` the flag is derived; prior stays are
    read only where their discharge can reach the period.
    """
    validate_period(start, end)
    # Encounters without a patient drop out at the patient join anyway; the
    # explicit not-null date equals the constraint Spark infers on the match
    # side, so both uses of the per-day aggregate below plan identically and
    # share one scan and shuffle.
    scope = encounters.where(F.col("EncounterType").isin(READMISSION_SCOPE)
                             & in_period("EncounterDate", start, end)
                             & F.col("PatientID").isNotNull()
                             & F.col("EncounterDate").isNotNull())
    if "IsReadmission" in encounters.columns:
        per_patient = (scope.groupBy("PatientID")
                       .agg(F.count(F.lit(1)).alias("_n"),
                            F.count_if(F.col("IsReadmission") == "Yes").alias("_yes")))
    else:
        # Count encounters per (patient, day) first: the flag depends only on
        # that key. The same aggregate feeds the totals and (as the probe side)
        # the readmission match, so encounters are scanned once for both.
        per_day = (scope.groupBy("PatientID", "EncounterDate")
                   .agg(F.count(F.lit(1)).alias("_n")))
        prior = encounters.where(F.col("DischargeDate").between(
            F.date_sub(F.lit(start), window_days), F.date_sub(F.lit(end), 1)))
        if method == "bucketed":
            hit_days = readmission_day_counts(per_day, prior, window_days)
        else:
            hits = readmission_days(per_day, prior, window_days, method=method,
                                    distinct_days=True)
            hit_days = per_day.join(hits, ["PatientID", "EncounterDate"])
        yes = hit_days.groupBy("PatientID").agg(F.sum("_n").alias("_yes"))
        per_patient = (per_day.groupBy("PatientID").agg(F.sum("_n").alias("_n"))
                       .join(yes, "PatientID", "left")
                       .select("PatientID", "_n",
                               F.coalesce("_yes", F.lit(0)).alias("_yes")))
    agg = (per_patient.join(_areas(patients), "PatientID")
           .groupBy("CatchmentArea")
           .agg(F.sum("_yes").alias("Numerator"), F.sum("_n").alias("Denominator")))
    out = agg.select(F.lit(None).alias("DepartmentID"), "CatchmentArea", "Numerator",
                     "Denominator", pct_half_up("Numerator", "Denominator",
                                                READMISSION_RATE.digits)
                     .alias("ComputedValue"))
    return _finish(out, READMISSION_RATE, start, end, computed_on)


def first_encounter_complication_rate(encounters: DataFrame, patients: DataFrame,
                                      start: dt.date, end: dt.date,
                                      computed_on: dt.date | None = None,
                                      method: str = "min_by") -> DataFrame:
    """Each patient's first encounter *within the period* (earliest date, then
    lowest EncounterID); share that is emergency or inpatient per catchment
    area (cutoffs 50 / 30).

    ``method="min_by"`` (default): ``min_by`` of the complication flag by the
    packed (date, id) key is a mergeable hash aggregate, so every task keeps
    one candidate per patient before the shuffle and a patient with a huge
    history costs one row, not one task.
    ``method="row_number"``: ``row_number() = 1`` per patient; Spark plans it as
    a per-partition group limit before the shuffle (sort-based) and a final
    limit after it, so it is also bounded per patient.
    """
    validate_period(start, end)
    scope = encounters.where(in_period("EncounterDate", start, end)
                             & F.col("PatientID").isNotNull())
    is_compl = F.coalesce(F.col("EncounterType").isin(COMPLICATION_TYPES), F.lit(False))
    if method == "min_by":
        first = (scope.groupBy("PatientID")
                 .agg(F.min_by(is_compl, date_id_order("EncounterDate", "EncounterID"))
                      .alias("_first_compl")))
    elif method == "row_number":
        w = Window.partitionBy("PatientID").orderBy("EncounterDate", "EncounterID")
        first = (scope.select("PatientID", is_compl.alias("_first_compl"),
                              F.row_number().over(w).alias("_rn"))
                 .where(F.col("_rn") == 1)
                 .select("PatientID", "_first_compl"))
    else:
        raise ValueError(f"unknown method {method!r}")
    agg = (first.join(_areas(patients), "PatientID")
           .groupBy("CatchmentArea")
           .agg(F.count_if("_first_compl").alias("Numerator"),
                F.count(F.lit(1)).alias("Denominator")))
    out = agg.select(F.lit(None).alias("DepartmentID"), "CatchmentArea", "Numerator",
                     "Denominator",
                     pct_half_up("Numerator", "Denominator",
                                 FIRST_ENCOUNTER_COMPLICATION.digits).alias("ComputedValue"))
    return _finish(out, FIRST_ENCOUNTER_COMPLICATION, start, end, computed_on)


def bed_utilization_rate(encounters: DataFrame, departments: DataFrame,
                         start: dt.date, end: dt.date,
                         computed_on: dt.date | None = None) -> DataFrame:
    """Σ length of stay of inpatient stays admitted in the period (not clipped
    to the period; open stays excluded) ÷ (beds × days) × 100 per department
    with beds (cutoffs 85 / 70).
    """
    days = validate_period(start, end)
    e = encounters if "LengthOfStayDays" in encounters.columns else with_length_of_stay(encounters)
    e = (e.where((F.col("EncounterType") == INPATIENT)
                 & (F.col("LengthOfStayDays") > 0)
                 & in_period("EncounterDate", start, end))
         .select("DepartmentID", "LengthOfStayDays"))
    beds = (departments.where(F.col("BedCapacity") > 0)
            .select("DepartmentID", "BedCapacity"))
    agg = (e.groupBy("DepartmentID").agg(F.sum("LengthOfStayDays").alias("Numerator"))
           .join(beds, "DepartmentID")
           .withColumn("Denominator", F.col("BedCapacity").cast("long") * days))
    out = agg.select("DepartmentID", F.lit(None).alias("CatchmentArea"), "Numerator",
                     "Denominator",
                     half_up_div(F.col("Numerator").cast("decimal(38,0)") * 100,
                                 "Denominator", BED_UTILIZATION.digits)
                     .alias("ComputedValue"))
    return _finish(out, BED_UTILIZATION, start, end, computed_on)


def provider_workload_index(encounters: DataFrame, staff: DataFrame, start: dt.date,
                            end: dt.date, computed_on: dt.date | None = None) -> DataFrame:
    """Encounters in the period ÷ (active clinical staff × days) per
    department; departments missing on either side are dropped (cutoffs
    0.5 / 0.3). Both sides are aggregated to one row per department first.
    """
    days = validate_period(start, end)
    visits = (encounters.where(in_period("EncounterDate", start, end))
              .groupBy("DepartmentID").agg(F.count(F.lit(1)).alias("Numerator")))
    clinicians = (staff.where((F.col("EmploymentStatus") == ACTIVE)
                              & F.col("Role").isin(CLINICAL_ROLES))
                  .groupBy("DepartmentID").agg(F.count(F.lit(1)).alias("_staff")))
    agg = (visits.join(clinicians, "DepartmentID")
           .withColumn("Denominator", F.col("_staff") * days))
    out = agg.select("DepartmentID", F.lit(None).alias("CatchmentArea"), "Numerator",
                     "Denominator",
                     half_up_div("Numerator", "Denominator", PROVIDER_WORKLOAD.digits)
                     .alias("ComputedValue"))
    return _finish(out, PROVIDER_WORKLOAD, start, end, computed_on)


def period_slice(encounters: DataFrame, start: dt.date, end: dt.date,
                 window_days: int = READMISSION_WINDOW_DAYS) -> DataFrame:
    """The encounter rows and columns the four indicators read: encounters of
    the period, plus stays whose discharge can make a period encounter a
    readmission."""
    keep = ["EncounterID", "PatientID", "DepartmentID", "EncounterType",
            "EncounterDate", "DischargeDate"]
    keep += [c for c in ("IsReadmission", "LengthOfStayDays") if c in encounters.columns]
    prior = F.col("DischargeDate").between(F.date_sub(F.lit(start), window_days),
                                           F.date_sub(F.lit(end), 1))
    return encounters.where(in_period("EncounterDate", start, end) | prior).select(*keep)


def compute_indicators(tables: Tables, start: dt.date, end: dt.date,
                       computed_on: dt.date | None = None,
                       method: str = "bucketed",
                       materialize_to: str | None = None) -> DataFrame:
    """All four indicators of the period, one frame (11 columns).

    Each branch reads ``encounters`` with its own pruned, filter-pushed scan.
    When the table is large and not clustered by date, pass
    ``materialize_to`` (a folder in shared storage): the period slice is
    written there once and the four branches read it instead.
    """
    validate_period(start, end)
    enc = tables.encounters
    if materialize_to:
        sl = period_slice(enc, start, end)
        sl.write.mode("overwrite").parquet(materialize_to)
        enc = enc.sparkSession.read.schema(sl.schema).parquet(materialize_to)
    parts = [
        readmission_rate(enc, tables.patients, start, end, computed_on, method=method),
        first_encounter_complication_rate(enc, tables.patients, start, end, computed_on),
        bed_utilization_rate(enc, tables.departments, start, end, computed_on),
        provider_workload_index(enc, tables.staff, start, end, computed_on),
    ]
    return functools.reduce(DataFrame.unionByName, parts).select(*INDICATOR_COLUMNS)


def indicator_report(indicators: DataFrame, departments: DataFrame) -> DataFrame:
    """Indicators with their department name, ``-`` for a missing area or
    department, sorted by name, area, department.

    → IndicatorName, CatchmentArea, DepartmentName, Numerator, Denominator,
      ComputedValue, SeverityFlag
    """
    names = departments.select("DepartmentID", "DepartmentName")
    j = indicators.join(names, "DepartmentID", "left")
    return (j.orderBy(F.col("IndicatorName").asc(),
                      F.coalesce(F.col("CatchmentArea"), F.lit("")).asc(),
                      F.col("DepartmentName").asc_nulls_first())
            .select("IndicatorName",
                    F.coalesce(F.col("CatchmentArea"), F.lit("-")).alias("CatchmentArea"),
                    F.coalesce(F.col("DepartmentName"), F.lit("-")).alias("DepartmentName"),
                    "Numerator", "Denominator", "ComputedValue", "SeverityFlag"))


__all__ = [
    "BED_UTILIZATION", "FIRST_ENCOUNTER_COMPLICATION", "INDICATOR_COLUMNS",
    "Indicator", "PROVIDER_WORKLOAD", "READMISSION_RATE", "bed_utilization_rate",
    "compute_indicators", "first_encounter_complication_rate", "indicator_report",
    "provider_workload_index", "readmission_rate", "validate_period",
]
