"""Patient-experience report: staff versus facility satisfaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.exact import avg_diff_half_up, avg_half_up
from wardlens.operators.common import asc, desc, per_department_name


def satisfaction_gap(surveys: DataFrame, encounters: DataFrame,
                     departments: DataFrame) -> DataFrame:
    """Per department: responses, mean staff and facility rating (1 decimal)
    and the gap of the *unrounded* means (rounded once, at the end).

    Surveys are summed per encounter first (partial aggregate, then a join
    on an already partitioned key).

    → DepartmentName, Responses, AvgStaff, AvgFacility, Gap
    """
    per_enc = (surveys.groupBy("EncounterID")
               .agg(F.count(F.lit(1)).alias("_n"),
                    F.count("StaffRating").alias("_ns"),
                    F.sum("StaffRating").alias("_ss"),
                    F.count("FacilityRating").alias("_nf"),
                    F.sum("FacilityRating").alias("_sf")))
    j = per_enc.join(encounters.select("EncounterID", "DepartmentID"), "EncounterID")
    agg = (per_department_name(j, departments, Responses=F.sum("_n"),
                               **{c: F.sum(c) for c in ("_ns", "_ss", "_nf", "_sf")})
           .select("DepartmentName", "Responses",
                   avg_half_up("_ss", "_ns", 1).alias("AvgStaff"),
                   avg_half_up("_sf", "_nf", 1).alias("AvgFacility"),
                   avg_diff_half_up("_ss", "_ns", "_sf", "_nf", 1).alias("Gap")))
    return agg.orderBy(desc("Gap"), asc("DepartmentName"))
