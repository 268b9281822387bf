"""Reports for the infection-control officer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.fixed_values import (COMPLAINT_DEPARTMENT_ID,
                                   INFECTION_WORDS, VACCINATED)
from wardlens.functions.columns import contains_any
from wardlens.operators.common import asc, desc, per_department_name, top_n, with_department_name


def complaint_clusters(encounters: DataFrame,
                       department_id: int = COMPLAINT_DEPARTMENT_ID,
                       n: int | None = 5) -> DataFrame:
    """Per chief complaint in one department: cases, first and last date.

    → ChiefComplaint, CaseCount, FirstCase, LastCase
    """
    agg = (encounters.where(F.col("DepartmentID") == department_id)
           .groupBy("ChiefComplaint")
           .agg(F.count(F.lit(1)).alias("CaseCount"),
                F.min("EncounterDate").alias("FirstCase"),
                F.max("EncounterDate").alias("LastCase")))
    return top_n(agg, n, desc("CaseCount"), asc("ChiefComplaint"))


def vaccination_gaps(staff: DataFrame, departments: DataFrame,
                     n: int | None = 5) -> DataFrame:
    """Per department: staff, and staff whose HBV / Tdap status is not
    complete (a missing status is unknown, so it is not counted).

    → DepartmentName, TotalStaff, HBV_Incomplete, Tdap_Incomplete
    """
    s = staff.select("DepartmentID", "VaxHBVStatus", "VaxTdapStatus")
    agg = per_department_name(
        s, departments, TotalStaff=F.count(F.lit(1)),
        HBV_Incomplete=F.count_if(F.col("VaxHBVStatus") != VACCINATED),
        Tdap_Incomplete=F.count_if(F.col("VaxTdapStatus") != VACCINATED))
    return top_n(agg, n, desc("HBV_Incomplete"), asc("DepartmentName"))


def infection_exposure(encounters: DataFrame, staff: DataFrame,
                       departments: DataFrame,
                       words: Sequence[str] = tuple(INFECTION_WORDS),
                       n: int | None = 10, by_id: bool = False) -> DataFrame:
    """Per staff member (first name, last name, role) and *encounter*
    department: encounters whose complaint mentions any of ``words``
    (case-insensitive). ``by_id=True`` keeps namesakes apart (adds StaffID).

    The encounters are counted per (StaffID, DepartmentID) before the staff
    join, so the join shuffles at most one row per pair.

    → FirstName, LastName, Role, DepartmentName, InfectionCases
    """
    per_pair = (encounters.where(contains_any("ChiefComplaint", words))
                .groupBy("StaffID", "DepartmentID")
                .agg(F.count(F.lit(1)).alias("_cases")))
    people = staff.select("StaffID", "FirstName", "LastName", "Role")
    j = with_department_name(per_pair.join(people, "StaffID"), departments)
    keys = (["StaffID"] if by_id else []) + ["FirstName", "LastName", "Role",
                                              "DepartmentName"]
    agg = j.groupBy(*keys).agg(F.sum("_cases").alias("InfectionCases"))
    return top_n(agg, n, desc("InfectionCases"), *[asc(k) for k in keys])
