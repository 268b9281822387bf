"""The indicators of many reporting periods, overlapping ones too, in one pass.

The periods' boundaries cut time into slots; every period is a run of slots. One
scan of the encounters gives the states that all indicators are made of, summed
in one aggregate (partial sums before the shuffle) and written once: bed days
and visits per department and slot, counts per patient and day, discharge days,
and each patient's first encounter per slot. The states are additive over slots,
but for the first encounter, which is a mergeable minimum: the first of a slot
is the first of a period if the period starts after the patient's slot before
and covers this one. The later steps read states, and after the areas are known
a few rows per area, department and slot.

No row is copied per period before it is down to areas or departments and slots.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.fixed_values import (ACTIVE, CLINICAL_ROLES, COMPLICATION_TYPES, INPATIENT,
                                   READMISSION_SCOPE)
from wardlens.functions.columns import date_id_order
from wardlens.functions.exact import half_up_div, pct_half_up
from wardlens.operators.derive import (PRIOR_STAY_TYPE, READMISSION_WINDOW_DAYS,
                                       readmission_day_counts)
from wardlens.plans.indicators import (BED_UTILIZATION, FIRST_ENCOUNTER_COMPLICATION,
                                       INDICATOR_COLUMNS, PROVIDER_WORKLOAD, READMISSION_RATE,
                                       Indicator, _areas, _finish, validate_period)
from wardlens.session import shared_dir
from wardlens.sources.model import Tables

Period = tuple[dt.date, dt.date]


class Slots:
    """The elementary intervals of some periods."""

    def __init__(self, tables: Tables, periods: list[Period]):
        for p in periods:
            validate_period(*p)
        self.spark = tables.encounters.sparkSession
        self.periods = sorted(set(periods))
        day = dt.timedelta(days=1)
        self.bounds = sorted({s for s, _ in self.periods} | {e + day for _, e in self.periods})
        self.first, self.last = self.bounds[0], self.bounds[-1] - day

    def calendar(self) -> DataFrame:
        """(day, slot): one row per day from the first start to the last end."""
        rows = [(i, a, b - dt.timedelta(days=1))
                for i, (a, b) in enumerate(zip(self.bounds, self.bounds[1:]))]
        return self.spark.createDataFrame(rows, "slot int, a date, b date").select(
            "slot", F.explode(F.sequence("a", "b")).alias("day"))

    def covered(self) -> DataFrame:
        """(slot, first_slot, start, end, days) for each slot of each period."""
        at = {d: i for i, d in enumerate(self.bounds)}
        rows = [(at[s], at[e + dt.timedelta(days=1)] - 1, s, e, (e - s).days + 1)
                for s, e in self.periods]
        return self.spark.createDataFrame(
            rows, "first_slot int, last_slot int, start date, end date, days int").select(
            F.explode(F.sequence("first_slot", "last_slot")).alias("slot"),
            "first_slot", "start", "end", "days")


def _measures(stored_flag: bool) -> Column:
    """The states that one encounter adds to, as an array of rows."""
    none = F.lit(None)
    inside = F.col("slot").isNotNull()
    patient = F.col("PatientID").isNotNull()
    yes = F.col("IsReadmission") == "Yes" if stored_flag else F.lit(False)

    def row(use: Column, kind: str, key: str, slot: Column, day: Column, m: Column,
            order: Column, hit: Column) -> Column:
        return F.struct(
            F.coalesce(use, F.lit(False)).alias("use"), F.lit(kind).alias("kind"),
            F.col(key).alias("key"), slot.cast("int").alias("slot"), day.cast("date").alias("day"),
            F.coalesce(m.cast("long"), F.lit(0)).alias("m"),
            order.cast("decimal(38,0)").alias("first"), hit.cast("boolean").alias("hit"))

    stay = (F.col("EncounterType") == INPATIENT) & (F.col("LengthOfStayDays") > 0)
    severe = F.coalesce(F.col("EncounterType").isin(COMPLICATION_TYPES), F.lit(False))
    rows = [
        row(inside & stay, "bed", "DepartmentID", F.col("slot"), none, F.col("LengthOfStayDays"),
            none, none),
        row(inside, "visit", "DepartmentID", F.col("slot"), none, none, none, none),
        row(inside & patient, "first", "PatientID", F.col("slot"), none, none,
            date_id_order("EncounterDate", "EncounterID"), severe),
        row(inside & patient & F.col("EncounterType").isin(READMISSION_SCOPE), "scope", "PatientID",
            F.col("slot"), F.col("EncounterDate"), yes.cast("int"), none, none),
    ]
    if not stored_flag:
        rows.append(row(patient & F.col("DischargeDate").isNotNull()
                        & (F.col("EncounterType") == PRIOR_STAY_TYPE), "discharge", "PatientID",
                        none, F.col("DischargeDate"), none, none, none))
    return F.filter(F.array(*rows), lambda r: r["use"])


def period_states(tables: Tables, slots: Slots,
                  window_days: int = READMISSION_WINDOW_DAYS) -> DataFrame:
    """(kind, key, slot, day, n, m, hit): the states of all indicators, from one
    scan of the encounters and one shuffle."""
    enc = tables.encounters
    flag, los = ("IsReadmission" in enc.columns, "LengthOfStayDays" in enc.columns)
    day = F.col("EncounterDate")
    prior = F.col("DischargeDate").between(
        F.lit(slots.first - dt.timedelta(days=window_days)),
        F.lit(slots.last - dt.timedelta(days=1)))
    rows = enc.where(day.between(F.lit(slots.first), F.lit(slots.last)) | prior).select(
        "EncounterID", "PatientID", "DepartmentID", "EncounterType", "EncounterDate", "DischargeDate",
        (F.col("LengthOfStayDays") if los else F.datediff("DischargeDate", "EncounterDate"))
        .alias("LengthOfStayDays"), *(["IsReadmission"] if flag else []))
    rows = rows.join(slots.calendar(), rows["EncounterDate"] == F.col("day"), "left").drop("day")
    return (rows.select(F.inline(_measures(flag)))
            .groupBy("kind", "key", "slot", "day")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("m"),
                 F.min_by("hit", "first").alias("hit")))


def compute_indicators_periods(tables: Tables, periods: list[Period],
                               computed_on: dt.date | None = None,
                               states_to: str | None = None) -> DataFrame:
    """``compute_indicators`` of every period (once each), one frame. The states
    are written to ``states_to`` (default: a new folder in the shared folder)."""
    slots = Slots(tables, periods)
    spark, covered = slots.spark, slots.covered()
    path = states_to or shared_dir(spark, None)
    states = period_states(tables, slots)
    states.write.mode("overwrite").partitionBy("kind").parquet(path)
    read = spark.read.schema(states.schema).parquet(path)

    def of(kind: str) -> DataFrame:
        return read.where(F.col("kind") == kind)

    per = ["start", "end", "days"]
    areas = _areas(tables.patients)

    def finish(rows: DataFrame, ind: Indicator, value: Column) -> DataFrame:
        own = rows.columns[0]
        other = "CatchmentArea" if own == "DepartmentID" else "DepartmentID"
        return _finish(rows.withColumns({other: F.lit(None), "ComputedValue": value}), ind,
                       F.col("start"), F.col("end"), computed_on)

    # Readmissions: flagged days of a patient, summed per slot, then per area.
    scope = of("scope").select(F.col("key").alias("PatientID"), "slot",
                               F.col("day").alias("EncounterDate"), "n", "m")
    if "IsReadmission" in tables.encounters.columns:
        counted = scope.groupBy("PatientID", "slot").agg(F.sum("n").alias("n"), F.sum("m").alias("yes"))
    else:
        prior = of("discharge").select(F.col("key").alias("PatientID"),
                                       F.col("day").alias("DischargeDate"),
                                       F.lit(PRIOR_STAY_TYPE).alias("EncounterType"))
        hits = readmission_day_counts(scope, prior, count="n").join(
            slots.calendar(), F.col("EncounterDate") == F.col("day"))
        counted = (scope.select("PatientID", "slot", "n", F.lit(0).cast("long").alias("yes"))
                   .unionByName(hits.select("PatientID", "slot", F.lit(0).cast("long").alias("n"),
                                            F.col("n").alias("yes")))
                   .groupBy("PatientID", "slot").agg(F.sum("n").alias("n"), F.sum("yes").alias("yes")))
    by_area = (counted.join(areas, "PatientID").groupBy("CatchmentArea", "slot")
               .agg(F.sum("yes").alias("yes"), F.sum("n").alias("n")))
    readmission = (by_area.join(covered, "slot").groupBy("CatchmentArea", *per)
                   .agg(F.sum("yes").alias("Numerator"), F.sum("n").alias("Denominator")))

    # First encounters: by the patient's slot before, which decides the periods.
    before = Window.partitionBy("key").orderBy("slot")
    firsts = (of("first").select("key", "slot", "hit", F.coalesce(
        F.lag("slot").over(before), F.lit(-1)).alias("prev")))
    first = (firsts.join(areas.withColumnRenamed("PatientID", "key"), "key")
             .groupBy("CatchmentArea", "slot", "prev")
             .agg(F.count_if("hit").alias("hits"), F.count(F.lit(1)).alias("n"))
             .join(covered, "slot").where("first_slot > prev")
             .groupBy("CatchmentArea", *per)
             .agg(F.sum("hits").alias("Numerator"), F.sum("n").alias("Denominator")))

    def department(kind: str, measure: str) -> DataFrame:
        return (of(kind).join(covered, "slot").groupBy(F.col("key").alias("DepartmentID"), *per)
                .agg(F.sum(measure).alias("Numerator")))

    beds = tables.departments.where(F.col("BedCapacity") > 0).select("DepartmentID", "BedCapacity")
    bed = (department("bed", "m").join(beds, "DepartmentID")
           .withColumn("Denominator", F.col("BedCapacity").cast("long") * F.col("days")))
    clinicians = (tables.staff.where((F.col("EmploymentStatus") == ACTIVE)
                                     & F.col("Role").isin(CLINICAL_ROLES))
                  .groupBy("DepartmentID").agg(F.count(F.lit(1)).alias("_staff")))
    visits = (department("visit", "n").join(clinicians, "DepartmentID")
              .withColumn("Denominator", F.col("_staff") * F.col("days")))
    parts = [
        finish(readmission, READMISSION_RATE,
               pct_half_up("Numerator", "Denominator", READMISSION_RATE.digits)),
        finish(first, FIRST_ENCOUNTER_COMPLICATION,
               pct_half_up("Numerator", "Denominator", FIRST_ENCOUNTER_COMPLICATION.digits)),
        finish(bed, BED_UTILIZATION,
               half_up_div(F.col("Numerator").cast("decimal(38,0)") * 100, "Denominator",
                           BED_UTILIZATION.digits)),
        finish(visits, PROVIDER_WORKLOAD,
               half_up_div("Numerator", "Denominator", PROVIDER_WORKLOAD.digits)),
    ]
    return functools.reduce(DataFrame.unionByName, parts).select(*INDICATOR_COLUMNS)


def rolling_periods(first: dt.date, count: int, months: int) -> list[Period]:
    """``count`` periods of some months, one starting in each month."""
    def month(n: int) -> dt.date:
        n += first.year * 12 + first.month - 1
        return dt.date(n // 12, n % 12 + 1, 1)
    return [(month(i), month(i + months) - dt.timedelta(days=1)) for i in range(count)]
