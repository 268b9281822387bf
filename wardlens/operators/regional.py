"""Reports for the regional health supervisor: length of stay, referral
rejection, volume and cost by visit type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.fixed_values import INPATIENT, OUTGOING, REJECTED
from wardlens.functions.exact import amount, avg_half_up, avg_money, money, pct_half_up
from wardlens.operators.common import asc, desc, per_department_name


def average_los(encounters: DataFrame, departments: DataFrame) -> DataFrame:
    """Closed inpatient stays per department and their mean length in days
    (1 decimal; stays of 0 days included).

    → DepartmentName, Admissions, AvgLOS
    """
    e = (encounters
         .where((F.col("EncounterType") == INPATIENT) & F.col("DischargeDate").isNotNull())
         .select("DepartmentID",
                 F.datediff("DischargeDate", "EncounterDate").alias("_los")))
    agg = (per_department_name(e, departments, Admissions=F.count(F.lit(1)),
                               _sum=F.sum("_los"), _n=F.count("_los"))
           .select("DepartmentName", "Admissions",
                   avg_half_up("_sum", "_n", 1).alias("AvgLOS")))
    return agg.orderBy(desc("AvgLOS"), asc("DepartmentName"))


def referral_rejection(referrals: DataFrame) -> DataFrame:
    """Outgoing referrals per receiving hospital: total, rejected, percent.

    → ReceivingHospital, TotalReferrals, Rejected, RejectionPct
    """
    agg = (referrals.where(F.col("ReferralDirection") == OUTGOING)
           .groupBy("ReceivingHospital")
           .agg(F.count(F.lit(1)).alias("TotalReferrals"),
                F.count_if(F.col("Status") == REJECTED).alias("Rejected"))
           .withColumn("RejectionPct", pct_half_up("Rejected", "TotalReferrals", 1)))
    return agg.orderBy(desc("RejectionPct"), asc("ReceivingHospital"))


def cost_by_type(encounters: DataFrame) -> DataFrame:
    """Count, total and mean cost per encounter type (exact sums).

    → EncounterType, Total, TotalCost, AvgCost
    """
    agg = (encounters.select("EncounterType", amount("EncounterCost").alias("_c"))
           .groupBy("EncounterType")
           .agg(F.count(F.lit(1)).alias("Total"),
                F.sum("_c").alias("_sum"), F.count("_c").alias("_n"))
           .select("EncounterType", "Total",
                   money("_sum").alias("TotalCost"),
                   avg_money("_sum", "_n", 2).alias("AvgCost")))
    return agg.orderBy(desc("Total"), asc("EncounterType"))
