"""Revenue-cycle reports: claim submission lag and denial rate.

Both pre-aggregate claims per ``EncounterID`` before joining the encounters:
the join then shuffles one row per encounter instead of one per claim, a
claim-heavy encounter collapses in the map-side partial aggregate, and the
aggregate's output is already hash-partitioned on the join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.fixed_values import DENIED, MIN_CLAIMS
from wardlens.functions.exact import amount, avg_half_up, money, pct_half_up
from wardlens.operators.common import asc, desc, per_department_name, top_n


def claim_lag(claims: DataFrame, encounters: DataFrame, departments: DataFrame,
              n: int | None = 10) -> DataFrame:
    """Claims per department and the mean days from encounter to submission.

    → DepartmentName, ClaimCount, AvgDaysToSubmit
    """
    per_enc = (claims.groupBy("EncounterID")
               .agg(F.count(F.lit(1)).alias("_n"),
                    F.count("DateSubmitted").alias("_n_sub"),
                    F.sum(F.unix_date("DateSubmitted")).alias("_sum_sub")))
    enc = encounters.select("EncounterID", "DepartmentID",
                            F.unix_date("EncounterDate").alias("_ed"))
    j = per_enc.join(enc, "EncounterID").select(
        "DepartmentID", "_n",
        F.when(F.col("_ed").isNotNull(), F.col("_n_sub")).otherwise(0).alias("_n_diff"),
        (F.col("_sum_sub") - F.col("_n_sub") * F.col("_ed")).alias("_sum_diff"))
    agg = (per_department_name(j, departments, ClaimCount=F.sum("_n"),
                               _s=F.sum("_sum_diff"), _d=F.sum("_n_diff"))
           .select("DepartmentName", "ClaimCount",
                   avg_half_up("_s", "_d", 1).alias("AvgDaysToSubmit")))
    return top_n(agg, n, desc("AvgDaysToSubmit"), asc("DepartmentName"))


def denial_rate(claims: DataFrame, encounters: DataFrame, departments: DataFrame,
                min_claims: int = MIN_CLAIMS) -> DataFrame:
    """Per department with at least ``min_claims`` claims: claims, denied,
    percent denied, denied amount and billed amount (exact sums).

    → DepartmentName, TotalClaims, DeniedClaims, DenialPct, RevenueLost, TotalBilled
    """
    denied = F.col("ClaimStatus") == DENIED
    billed = amount("BilledAmount")
    per_enc = (claims.groupBy("EncounterID")
               .agg(F.count(F.lit(1)).alias("_n"),
                    F.count_if(denied).alias("_denied"),
                    F.sum(F.when(denied, billed).otherwise(0)).alias("_lost"),
                    F.sum(billed).alias("_billed")))
    j = per_enc.join(encounters.select("EncounterID", "DepartmentID"), "EncounterID")
    agg = (per_department_name(j, departments, TotalClaims=F.sum("_n"),
                               DeniedClaims=F.sum("_denied"), _lost=F.sum("_lost"),
                               _billed=F.sum("_billed"))
           .where(F.col("TotalClaims") >= min_claims)
           .select("DepartmentName", "TotalClaims", "DeniedClaims",
                   pct_half_up("DeniedClaims", "TotalClaims", 1).alias("DenialPct"),
                   money("_lost").alias("RevenueLost"),
                   money("_billed").alias("TotalBilled")))
    return agg.orderBy(desc("DenialPct"), asc("DepartmentName"))
