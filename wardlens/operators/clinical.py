"""Clinical reports: chronic-disease complications, costliest stays, and the
patient-level chronic risk classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.fixed_values import (CHRONIC_PATTERN, COMPLICATION_TYPES,
                                   COST_RANK_CUT, INPATIENT, RISK_LEVELS)
from wardlens.functions.columns import matches_lower, value_order
from wardlens.functions.exact import amount, avg_money, pct_half_up
from wardlens.operators.common import asc, desc, top_n, with_department_name
from wardlens.operators.derive import (readmission_days, with_catchment_area,
                                       with_length_of_stay)


def _areas(patients: DataFrame) -> DataFrame:
    p = patients if "CatchmentArea" in patients.columns else with_catchment_area(patients)
    return p.select("PatientID", "CatchmentArea")


def _is_complication() -> F.Column:
    return F.col("EncounterType").isin(COMPLICATION_TYPES)


def chronic_complications(encounters: DataFrame, patients: DataFrame,
                          pattern: str = CHRONIC_PATTERN) -> DataFrame:
    """Chronic-disease encounters by catchment area and insurance: total,
    emergency+inpatient count and percent, mean cost.

    Encounters are aggregated per (PatientID, InsuranceType) before the
    patient join (the join is N:1), so a heavy patient collapses map-side.

    → CatchmentArea, InsuranceType, TotalEncounters, Complications,
      ComplicationPct, AvgCost
    """
    per = (encounters.where(matches_lower("ChiefComplaint", pattern))
           .select("PatientID", "InsuranceType", _is_complication().alias("_c"),
                   amount("EncounterCost").alias("_cost"))
           .groupBy("PatientID", "InsuranceType")
           .agg(F.count(F.lit(1)).alias("_n"), F.count_if("_c").alias("_k"),
                F.sum("_cost").alias("_sc"), F.count("_cost").alias("_nc")))
    agg = (per.join(_areas(patients), "PatientID")
           .groupBy("CatchmentArea", "InsuranceType")
           .agg(F.sum("_n").alias("TotalEncounters"), F.sum("_k").alias("Complications"),
                F.sum("_sc").alias("_sc"), F.sum("_nc").alias("_nc"))
           .select("CatchmentArea", "InsuranceType", "TotalEncounters", "Complications",
                   pct_half_up("Complications", "TotalEncounters", 1).alias("ComplicationPct"),
                   avg_money("_sc", "_nc", 2).alias("AvgCost")))
    return agg.orderBy(asc("CatchmentArea"), desc("ComplicationPct"), asc("InsuranceType"))


def costliest_stays(encounters: DataFrame, departments: DataFrame,
                    k: int = COST_RANK_CUT) -> DataFrame:
    """The ``k`` costliest inpatient stays longer than 0 days per department;
    equal costs share a rank (so more than ``k`` rows can qualify).

    ``rank() <= k`` is planned as a per-partition group limit before the
    shuffle, so only each partition's top rows per department move.

    → DepartmentName, EncounterID, ChiefComplaint, InsuranceType,
      EncounterCost, LengthOfStayDays, CostRank
    """
    e = encounters if "LengthOfStayDays" in encounters.columns else with_length_of_stay(encounters)
    e = (e.where((F.col("EncounterType") == INPATIENT)
                 & F.col("LengthOfStayDays").isNotNull()
                 & (F.col("LengthOfStayDays") > 0))
         .select("DepartmentID", "EncounterID", "ChiefComplaint", "InsuranceType",
                 "EncounterCost", "LengthOfStayDays"))
    cost = F.col("EncounterCost").desc_nulls_last()
    own, named = Window.partitionBy("DepartmentID"), Window.partitionBy("DepartmentName")
    # A stay among the first of its department's name is among the first of
    # its department, so only those meet the names.
    first = (e.withColumn("_rank", F.rank().over(own.orderBy(cost)))
             .where(F.col("_rank") <= k).drop("_rank"))
    ranked = (with_department_name(first, departments)
              .withColumn("CostRank", F.rank().over(named.orderBy(cost)))
              .where(F.col("CostRank") <= k))
    return ranked.select("DepartmentName", "EncounterID", "ChiefComplaint",
                         "InsuranceType", "EncounterCost", "LengthOfStayDays",
                         "CostRank").orderBy(asc("DepartmentName"), asc("CostRank"),
                                             asc("EncounterID"))


def risk_tier(complications: F.Column, readmissions: F.Column, denied: F.Column) -> F.Column:
    """First match wins: ≥2 complications → High; 1 and a readmission → High;
    1, or ≥2 denied claims → Moderate; else Low."""
    return (F.when(complications >= 2, "High")
             .when((complications == 1) & (readmissions >= 1), "High")
             .when((complications == 1) | (denied >= 2), "Moderate")
             .otherwise("Low"))


def risk_tiers(encounters: DataFrame, patients: DataFrame, claims: DataFrame,
               pattern: str = CHRONIC_PATTERN, n: int | None = 20,
               readmission_method: str = "bucketed") -> DataFrame:
    """One row per chronic patient: counts, denials and a risk level; sorted
    High → Moderate → Low, then complications and mean cost descending.

    The readmission flag is derived for the chronic encounters against *all*
    encounters (any closed inpatient stay is a prior stay) unless the frame
    already carries ``IsReadmission``.

    Plan: claims are counted per encounter and joined to the chronic
    encounters (the only shuffle of encounter rows); the result is summed per
    (patient, day) — the key the readmission flag depends on — so the flag is
    joined to day-level rows on their existing partitioning; then everything is
    summed per patient before the patient join. ``MAX(InsuranceType)`` comes from
    the same rows: it makes the aggregates sort-based, but spares another scan,
    two shuffles and a join.

    → PatientID, CatchmentArea, InsuranceType, ChronicEncounters,
      ComplicationCount, ReadmissionCount, AvgCost, TotalClaims, DeniedClaims,
      RiskLevel
    """
    cols = ["EncounterID", "PatientID", "EncounterDate", "EncounterType",
            "InsuranceType", "EncounterCost"]
    has_flag = "IsReadmission" in encounters.columns
    chronic = (encounters.where(matches_lower("ChiefComplaint", pattern))
               .select(*cols, *(["IsReadmission"] if has_flag else [])))
    per_claims = (claims.groupBy("EncounterID")
                  .agg(F.count(F.lit(1)).alias("_claims"),
                       F.count_if(F.lower("ClaimStatus") == "denied").alias("_denied")))
    readmit = (F.count_if(F.col("IsReadmission") == "Yes") if has_flag
               else F.lit(0).cast("long"))
    per_day = (chronic.join(per_claims, "EncounterID", "left")
               .groupBy("PatientID", "EncounterDate")
               .agg(F.count(F.lit(1)).alias("_n"),
                    F.count_if(_is_complication()).alias("_k"),
                    readmit.alias("_r"),
                    F.sum(amount("EncounterCost")).alias("_sc"),
                    F.count("EncounterCost").alias("_nc"),
                    F.sum("_claims").alias("_claims"),
                    F.sum("_denied").alias("_denied"),
                    F.max("InsuranceType").alias("_ins")))
    if not has_flag:
        # The day rows themselves are the probe side of the match.
        hits = (readmission_days(per_day, prior=encounters, method=readmission_method,
                                 distinct_days=True)
                .withColumn("_hit", F.lit(True)))
        per_day = (per_day.join(hits, ["PatientID", "EncounterDate"], "left")
                   .withColumn("_r", F.when(F.col("_hit"), F.col("_n")).otherwise(0)))
    per_patient = (per_day.groupBy("PatientID")
                   .agg(F.sum("_n").alias("ChronicEncounters"),
                        F.sum("_k").alias("ComplicationCount"),
                        F.sum("_r").alias("ReadmissionCount"),
                        F.sum("_sc").alias("_sc"), F.sum("_nc").alias("_nc"),
                        F.coalesce(F.sum("_claims"), F.lit(0)).alias("TotalClaims"),
                        F.coalesce(F.sum("_denied"), F.lit(0)).alias("DeniedClaims"),
                        F.max("_ins").alias("InsuranceType")))
    res = (per_patient.join(_areas(patients), "PatientID")
           .select("PatientID", "CatchmentArea", "InsuranceType", "ChronicEncounters",
                   "ComplicationCount", "ReadmissionCount",
                   avg_money("_sc", "_nc", 2).alias("AvgCost"), "TotalClaims",
                   "DeniedClaims",
                   risk_tier(F.col("ComplicationCount"), F.col("ReadmissionCount"),
                             F.col("DeniedClaims")).alias("RiskLevel")))
    return top_n(res, n, value_order("RiskLevel", RISK_LEVELS).asc(),
                 desc("ComplicationCount"), desc("AvgCost"), asc("PatientID"))
