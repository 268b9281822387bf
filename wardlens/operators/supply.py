"""Reports for the supply and pharmacy manager: low stock, expiry, value."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.fixed_values import EXPIRY_HORIZON_DAYS
from wardlens.functions.exact import money, times
from wardlens.operators.common import asc, desc, per_department_name, top_n, with_department_name


def low_stock(supplies: DataFrame, departments: DataFrame, n: int | None = 5) -> DataFrame:
    """Items strictly below their reorder threshold, largest shortfall first.

    → SupplyName, StockLevel, ReorderThreshold, DepartmentName
    """
    s = (supplies.where(F.col("StockLevel") < F.col("ReorderThreshold"))
         .select("SupplyID", "SupplyName", "StockLevel", "ReorderThreshold",
                 "DepartmentID"))
    j = with_department_name(s, departments)
    return top_n(j, n, (F.col("StockLevel") - F.col("ReorderThreshold")).asc(),
                 asc("SupplyID")).select(
        "SupplyName", "StockLevel", "ReorderThreshold", "DepartmentName")


def expiry_watch(supplies: DataFrame, departments: DataFrame,
                 as_of: dt.date | None = None,
                 horizon_days: int = EXPIRY_HORIZON_DAYS,
                 n: int | None = 5) -> DataFrame:
    """Per department: items expired before ``as_of``, expiring within
    ``horizon_days`` (``as_of`` counts as expiring), and dated items.

    → DepartmentName, Expired, ExpiringSoon, TotalItems
    """
    today = F.lit(as_of) if as_of is not None else F.current_date()
    exp = F.col("ExpirationDate")
    s = (supplies.where(exp.isNotNull())
         .select("SupplyID", "DepartmentID", "ExpirationDate"))
    agg = per_department_name(
        s, departments, Expired=F.count_if(exp < today),
        ExpiringSoon=F.count_if(exp.between(today, F.date_add(today, horizon_days))),
        TotalItems=F.count("SupplyID"))
    return top_n(agg, n, desc("Expired"), asc("DepartmentName"))


def inventory_value(supplies: DataFrame, departments: DataFrame,
                    n: int | None = 5) -> DataFrame:
    """Item count and Σ stock × unit cost per department (exact sums).

    → DepartmentName, ItemCount, TotalValue
    """
    s = supplies.select(
        "SupplyID", "DepartmentID",
        times("UnitCost", "StockLevel").alias("_value"))
    agg = (per_department_name(s, departments, ItemCount=F.count("SupplyID"),
                               _value=F.sum("_value"))
           .select("DepartmentName", "ItemCount", money("_value").alias("TotalValue")))
    return top_n(agg, n, desc("TotalValue"), asc("DepartmentName"))
