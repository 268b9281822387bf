"""Small shared pieces of the report operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_department_name(df: DataFrame, departments: DataFrame,
                         how: str = "inner") -> DataFrame:
    """Attach ``DepartmentName`` by ``DepartmentID``. No hint: Spark broadcasts
    the departments only where their measured bytes allow it."""
    return df.join(departments.select("DepartmentID", "DepartmentName"), "DepartmentID", how)


def per_department_name(df: DataFrame, departments: DataFrame, **measures: Column) -> DataFrame:
    """Counts and sums per ``DepartmentName``: taken per ``DepartmentID`` first
    (partial sums per task), so only one row per department meets the names;
    departments that share a name are then added up."""
    agg = df.groupBy("DepartmentID").agg(*[c.alias(n) for n, c in measures.items()])
    return (with_department_name(agg, departments).groupBy("DepartmentName")
            .agg(*[F.sum(n).alias(n) for n in measures]))


def top_n(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    """``ORDER BY … LIMIT n``: planned as a bounded top-k (no global sort).
    Callers end ``order`` with a unique key so the cut is deterministic."""
    out = df.orderBy(*order)
    return out.limit(n) if n is not None else out


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def asc(name: str) -> Column:
    return F.col(name).asc_nulls_first()
