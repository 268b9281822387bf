"""Reports from additive daily states.

Facts are summed once per report, key and day into a state: counts and exact
sums, which add up over days and can be taken back. A change is given as the
facts as they are and as they were; the states of the former are added, of the
latter retracted. Any range of days, or all of time, is answered from the states
without reading facts. First and last days come from the days whose count is
left above zero, so they, too, survive retractions.

States live in a versioned table: a batch is one part, visible whole or not at
all, and ``compact`` folds all parts into one. A state row is one per report,
key and day, so their number does not grow with the facts of a day.

The day of a fact is its encounter's date (length of stay, cost, complications,
complaints, claim lag), the date a claim was submitted (denials), a survey was
made or a referral was requested. Facts without that day count for all of time
and for no range.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.fixed_values import (CHRONIC_PATTERN, COMPLAINT_DEPARTMENT_ID, COMPLICATION_TYPES,
                                   DENIED, INPATIENT, MIN_CLAIMS, OUTGOING, REJECTED)
from wardlens.functions.columns import matches_lower
from wardlens.functions.exact import (amount, avg_diff_half_up, avg_half_up, avg_money, money,
                                      pct_half_up)
from wardlens.operators.common import per_department_name, top_n
from wardlens.operators.derive import with_catchment_area
from wardlens.sources.model import Tables
from wardlens.sources.versions import VersionedTable

_COUNTS, _SUMS, _SUM_TYPE = 5, 2, "decimal(38,12)"
_KEYS = ["report", "k1", "k2", "day"]
_MEASURES = [*[f"n{i + 1}" for i in range(_COUNTS)], *[f"s{i + 1}" for i in range(_SUMS)]]
SCHEMA = ("report string, k1 string, k2 string, day date, "
          + ", ".join(f"{m} {'long' if m[0] == 'n' else _SUM_TYPE}" for m in _MEASURES))


def _fact(report: str, where: Column | bool, day: Column | str, k1: str, k2: str | None = None,
          **measures: Column) -> Column:
    """What one row adds to a report's state, null if it is not in the report;
    measures that the report lacks, or that are unknown, are null."""
    def typed(c: Column | None, kind: str) -> Column:
        return (F.lit(None) if c is None else c).cast(kind)
    keys = [F.lit(report).alias("report"), F.col(k1).cast("string").alias("k1"),
            typed(F.col(k2) if k2 else None, "string").alias("k2"),
            (F.col(day) if isinstance(day, str) else day).alias("day")]
    row = F.struct(*keys, *[typed(measures.get(m), "long" if m[0] == "n" else _SUM_TYPE).alias(m)
                            for m in _MEASURES])
    return row if where is True else F.when(where, row)


def _facts(rows: DataFrame, *facts: Column) -> DataFrame:
    """One row per report that a row counts in, with the row's sign."""
    return rows.select("sign", F.inline(F.array(*facts))).where("report IS NOT NULL")


def _known(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).isNotNull().cast("long")


def _is(condition: Column) -> Column:
    return condition.cast("long")


def _all(sides: list[tuple[Tables, int]], name: str) -> DataFrame | None:
    """A table's rows of all sides that have it, with their sign."""
    found = [getattr(t, name).withColumn("sign", F.lit(sign)) for t, sign in sides
             if getattr(t, name) is not None]
    return functools.reduce(DataFrame.unionByName, found) if found else None


def report_states(sides: list[tuple[Tables, int]]) -> DataFrame | None:
    """The states of the facts of (tables, sign) sides; tables that are not given
    add nothing. Rows count in all their reports at once, encounters are joined
    once to their claims and surveys, and all is summed in one aggregate."""
    out = []
    one, cost = F.lit(1), amount("EncounterCost")
    with_enc = [(t, s) for t, s in sides if t.encounters is not None]
    with_areas = [(t, s) for t, s in with_enc if t.patients is not None]
    enc = _all(with_enc, "encounters")
    if enc is not None:
        los = F.datediff("DischargeDate", "EncounterDate")
        out.append(_facts(
            enc,
            _fact("average_los", (F.col("EncounterType") == INPATIENT) & F.col("DischargeDate").isNotNull(),
                  "EncounterDate", "DepartmentID", n1=one, n2=los, n3=_known(los)),
            _fact("cost_by_type", True, "EncounterDate", "EncounterType", n1=one, n2=_known(cost), s1=cost),
            _fact("complaint_clusters", F.col("DepartmentID") == COMPLAINT_DEPARTMENT_ID, "EncounterDate",
                  "ChiefComplaint", n1=one)))
    if with_areas:
        areas = functools.reduce(DataFrame.unionByName, [
            with_catchment_area(t.patients).select("PatientID", "CatchmentArea", F.lit(s).alias("sign"))
            for t, s in with_areas])
        chronic = (_all(with_areas, "encounters").where(matches_lower("ChiefComplaint", CHRONIC_PATTERN))
                   .join(areas, ["PatientID", "sign"]))
        out.append(_facts(chronic, _fact(
            "chronic_complications", True, "EncounterDate", "CatchmentArea", "InsuranceType", n1=one,
            n2=_is(F.col("EncounterType").isin(COMPLICATION_TYPES)), n3=_known(cost), s1=cost)))
    claims, surveys = _all(with_enc, "billing_claims"), _all(with_enc, "satisfaction_surveys")
    # What is known of an encounter, claims and surveys alike.
    told = {"claim": (claims, {"made": "DateSubmitted", "status": "ClaimStatus", "billed": "BilledAmount"}),
            "survey": (surveys, {"made": "SurveyDate", "staff": "StaffRating", "facility": "FacilityRating"})}
    told = [rows.select(F.lit(kind).alias("kind"), "EncounterID", "sign",
                        *[F.col(c).alias(n) for n, c in names.items()])
            for kind, (rows, names) in told.items() if rows is not None]
    if told:
        both = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), told)
        at = enc.select("EncounterID", "DepartmentID", "EncounterDate", "sign")
        both = both.join(at, ["EncounterID", "sign"])
        facts = []
        if claims is not None:
            waited, claim = F.datediff("made", "EncounterDate"), F.col("kind") == "claim"
            billed, denied = amount("billed"), F.col("status") == DENIED
            facts += [
                _fact("claim_lag", claim, "EncounterDate", "DepartmentID", n1=one, n2=_known(waited),
                      n3=waited),
                _fact("denial_rate", claim, "made", "DepartmentID", n1=one, n2=_is(denied),
                      n3=_known("billed"), s1=F.when(denied, billed), s2=billed)]
        if surveys is not None:
            facts.append(_fact("satisfaction_gap", F.col("kind") == "survey", "made", "DepartmentID",
                               n1=one, n2=_known("staff"), n3=F.col("staff"), n4=_known("facility"),
                               n5=F.col("facility")))
        out.append(_facts(both, *facts))
    referrals = _all(sides, "referrals")
    if referrals is not None:
        out.append(_facts(referrals, _fact(
            "referral_rejection", F.col("ReferralDirection") == OUTGOING, "DateRequested",
            "ReceivingHospital", n1=one, n2=_is(F.col("Status") == REJECTED))))
    if not out:
        return None
    signed = [F.when(F.col("sign") < 0, -F.col(m)).otherwise(F.col(m)).alias(m) for m in _MEASURES]
    return _added([part.select(*_KEYS, *signed) for part in out])


def _added(parts: list[DataFrame]) -> DataFrame:
    return (functools.reduce(DataFrame.unionByName, parts).groupBy(*_KEYS)
            .agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("long" if m[0] == "n" else _SUM_TYPE).alias(m)
                   for m in _MEASURES]))


class ReportStates:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.table = spark, VersionedTable(spark, root)
        self.schema = spark.createDataFrame([], SCHEMA).schema

    def apply(self, batch: str, after: Tables | None = None, before: Tables | None = None) -> bool:
        """Add the states of ``after`` and retract those of ``before`` as one
        batch; False if a batch of that name was applied. A changed encounter is
        given with its claims and surveys, as they are joined to it."""
        base = self.table.newest()
        if batch in self.table.parts(base):
            return False
        found = report_states([(t, s) for t, s in ((after, 1), (before, -1)) if t is not None])
        folder = ""
        if found is not None:
            folder = self.table.new_folder()
            found.repartition("report", "day").sortWithinPartitions("report", "day") \
                .write.parquet(self.table.path(folder))
        self.table.commit(base, {batch: folder})
        return True

    def compact(self) -> None:
        """Fold all batches into one part; their names stay known."""
        base = self.table.newest()
        live = self.table.parts(base)
        if not any(live.values()):
            return
        folder = self.table.new_folder()
        left = functools.reduce(lambda a, b: a | b, [F.col(m) != 0 for m in _MEASURES])
        _added([self._rows(base)]).where(left).repartition("report", "day") \
            .sortWithinPartitions("report", "day").write.parquet(self.table.path(folder))
        names = sorted(live)
        self.table.commit(base, {n: folder if i == 0 else "" for i, n in enumerate(names)})

    def _rows(self, version: int | None = None) -> DataFrame:
        folders = sorted({f for f in self.table.parts(version).values() if f})
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*map(self.table.path, folders))

    def states(self, report: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """A report's states, of a range of days if one is given."""
        rows = self._rows().where(F.col("report") == report)
        if start is not None or end is not None:
            rows = rows.where(F.col("day").between(F.lit(start or dt.date.min), F.lit(end or dt.date.max)))
        return rows

    def report(self, name: str, departments: DataFrame | None = None, start: dt.date | None = None,
               end: dt.date | None = None) -> DataFrame:
        """A report over a range of days (all of time without one), with the
        columns and the order of the report function of that name."""
        return _ANSWERS[name](self.states(name, start, end), departments)


def _named(rows: DataFrame, departments: DataFrame) -> DataFrame:
    """Sums per department name of what is left; names without facts go."""
    rows = rows.withColumn("DepartmentID", F.col("k1").cast("long"))
    return per_department_name(rows, departments, **{m: F.sum(m) for m in _MEASURES}).where("n1 > 0")


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in _MEASURES]).where("n1 > 0")


def _by(name: str, *others: str) -> list[Column]:
    return [F.col(name).desc_nulls_last(), *[F.col(o).asc_nulls_first() for o in others]]


def _average_los(rows: DataFrame, departments: DataFrame) -> DataFrame:
    return _named(rows, departments).select(
        "DepartmentName", F.col("n1").alias("Admissions"), avg_half_up("n2", "n3", 1).alias("AvgLOS")
    ).orderBy(*_by("AvgLOS", "DepartmentName"))


def _cost_by_type(rows: DataFrame, _: DataFrame | None) -> DataFrame:
    some = F.col("n2") > 0  # no amounts, no total
    return _summed(rows, "k1").select(
        F.col("k1").alias("EncounterType"), F.col("n1").alias("Total"),
        F.when(some, money("s1")).alias("TotalCost"),
        F.when(some, avg_money("s1", "n2", 2)).alias("AvgCost")).orderBy(*_by("Total", "EncounterType"))


def _complaint_clusters(rows: DataFrame, _: DataFrame | None) -> DataFrame:
    days = rows.groupBy("k1", "day").agg(F.sum("n1").alias("n")).where("n > 0")
    return top_n(days.groupBy(F.col("k1").alias("ChiefComplaint")).agg(
        F.sum("n").alias("CaseCount"), F.min("day").alias("FirstCase"), F.max("day").alias("LastCase")),
        5, *_by("CaseCount", "ChiefComplaint"))


def _chronic_complications(rows: DataFrame, _: DataFrame | None) -> DataFrame:
    return _summed(rows, "k1", "k2").select(
        F.col("k1").alias("CatchmentArea"), F.col("k2").alias("InsuranceType"),
        F.col("n1").alias("TotalEncounters"), F.col("n2").alias("Complications"),
        pct_half_up("n2", "n1", 1).alias("ComplicationPct"),
        F.when(F.col("n3") > 0, avg_money("s1", "n3", 2)).alias("AvgCost")
    ).orderBy("CatchmentArea", F.desc("ComplicationPct"), "InsuranceType")


def _claim_lag(rows: DataFrame, departments: DataFrame) -> DataFrame:
    return top_n(_named(rows, departments).select(
        "DepartmentName", F.col("n1").alias("ClaimCount"),
        avg_half_up("n3", "n2", 1).alias("AvgDaysToSubmit")), 10, *_by("AvgDaysToSubmit", "DepartmentName"))


def _denial_rate(rows: DataFrame, departments: DataFrame) -> DataFrame:
    return _named(rows, departments).where(F.col("n1") >= MIN_CLAIMS).select(
        "DepartmentName", F.col("n1").alias("TotalClaims"), F.col("n2").alias("DeniedClaims"),
        pct_half_up("n2", "n1", 1).alias("DenialPct"),
        # Sums of no amounts at all are null, as in the report.
        F.when((F.col("n3") > 0) | (F.col("n2") < F.col("n1")), money("s1")).alias("RevenueLost"),
        F.when(F.col("n3") > 0, money("s2")).alias("TotalBilled")).orderBy(*_by("DenialPct", "DepartmentName"))


def _satisfaction_gap(rows: DataFrame, departments: DataFrame) -> DataFrame:
    return _named(rows, departments).select(
        "DepartmentName", F.col("n1").alias("Responses"), avg_half_up("n3", "n2", 1).alias("AvgStaff"),
        avg_half_up("n5", "n4", 1).alias("AvgFacility"),
        avg_diff_half_up("n3", "n2", "n5", "n4", 1).alias("Gap")).orderBy(*_by("Gap", "DepartmentName"))


def _referral_rejection(rows: DataFrame, _: DataFrame | None) -> DataFrame:
    return _summed(rows, "k1").select(
        F.col("k1").alias("ReceivingHospital"), F.col("n1").alias("TotalReferrals"),
        F.col("n2").alias("Rejected"), pct_half_up("n2", "n1", 1).alias("RejectionPct")
    ).orderBy(*_by("RejectionPct", "ReceivingHospital"))


_ANSWERS = {"average_los": _average_los, "cost_by_type": _cost_by_type,
            "complaint_clusters": _complaint_clusters, "claim_lag": _claim_lag,
            "chronic_complications": _chronic_complications, "denial_rate": _denial_rate,
            "satisfaction_gap": _satisfaction_gap, "referral_rejection": _referral_rejection}
REPORTS = tuple(_ANSWERS)


def slice_facts(t: Tables, low: int, high: int) -> Tables:
    """Some tenths of the facts: an encounter comes with its claims and surveys."""
    def some(df: DataFrame, key: str) -> DataFrame:
        part = F.pmod(F.xxhash64(key), F.lit(10))
        return df.where((part >= low) & (part < high))
    return Tables(patients=t.patients, encounters=some(t.encounters, "EncounterID"),
                  billing_claims=some(t.billing_claims, "EncounterID"),
                  satisfaction_surveys=some(t.satisfaction_surveys, "EncounterID"),
                  referrals=some(t.referrals, "ReferralID"))


def replay_facts(states: ReportStates, t: Tables) -> None:
    """All facts in batches, a tenth of them taken back and given again."""
    states.apply("load-1", slice_facts(t, 0, 6))
    states.apply("load-2", slice_facts(t, 6, 10), before=slice_facts(t, 2, 3))
    states.compact()
    states.apply("load-3", slice_facts(t, 2, 3))
    states.apply("load-1", slice_facts(t, 0, 6))  # known, does nothing
