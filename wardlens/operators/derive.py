"""Derived columns of the model: length of stay, 30-day readmission flag,
catchment area. Each is a pure ``DataFrame -> DataFrame`` function; nothing is
updated in place.

Readmission rule: an encounter is a readmission when it starts strictly after,
and at most ``window_days`` after, the discharge of any closed ``prior_type``
stay of the same patient (any encounter type can be flagged; an encounter is
flagged once however many stays match).

Scale notes. A naive self join on the patient key emits every pair of a
patient's encounters: one heavy patient (a third of all rows) makes it
quadratic. Both forms below first reduce each side to distinct
``(PatientID, day)`` rows — at most one row per calendar day per patient, a bound
that does not grow with the data — and only then look for matches:

* ``bucketed`` (default): a range join turned into an equi-join on
  ``(PatientID, day bucket)``; each start day probes at most two buckets of
  ``window_days`` days, so every join group holds at most ``window_days``
  discharge days and ``2 * window_days`` start days.
* ``window``: the deduplicated start and discharge days form a per-patient
  timeline and a ``rangeBetween(-window_days, -1)`` window asks whether a
  discharge lies in the window. Per-patient groups are bounded by the number
  of calendar days spanned.

The matched ``(PatientID, day)`` keys are joined back to the encounters with a
left join (one match row per key, so no duplication).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.fixed_values import (CATCHMENT_AREAS, PRIOR_STAY_TYPE,
                                   READMISSION_WINDOW_DAYS, UNASSIGNED)
from wardlens.functions.columns import label_by_lists, yes_no
from wardlens.sources.model import Tables


def with_length_of_stay(encounters: DataFrame) -> DataFrame:
    """+ ``LengthOfStayDays``: discharge − encounter date in days, null while open."""
    return encounters.withColumn(
        "LengthOfStayDays", F.datediff("DischargeDate", "EncounterDate"))


def with_catchment_area(patients: DataFrame,
                        mapping: Mapping[str, Sequence[str]] | DataFrame | None = None,
                        default: str = UNASSIGNED) -> DataFrame:
    """+ ``CatchmentArea`` from the ZIP code.

    ``mapping`` is either ``{area: [zip, ...]}`` (a ``CASE`` chain; the first
    listed area wins) or a frame ``(Zip, CatchmentArea)``, the form for large ZIP
    tables; of a ZIP with several areas the first in name order counts.
    Unmapped and null ZIPs get ``default``.
    """
    if isinstance(mapping, DataFrame):
        m = mapping.groupBy("Zip").agg(F.min("CatchmentArea").alias("_area"))
        cols = [c for c in patients.columns if c != "CatchmentArea"]
        return (patients.select(*cols).join(m, "Zip", "left")
                .withColumn("CatchmentArea", F.coalesce("_area", F.lit(default)))
                .select(*cols, "CatchmentArea"))
    return patients.withColumn(
        "CatchmentArea", label_by_lists("Zip", mapping or CATCHMENT_AREAS, default))


def _start_days(encounters: DataFrame, distinct: bool = False) -> DataFrame:
    days = (encounters
            .where(F.col("PatientID").isNotNull() & F.col("EncounterDate").isNotNull())
            .select("PatientID", F.col("EncounterDate").alias("day")))
    # An input that is already one row per (PatientID, EncounterDate) — an
    # aggregate on those keys — is used as is, so its exchange can be reused.
    return days if distinct else days.distinct()


def _discharge_days(prior: DataFrame, prior_type: str) -> DataFrame:
    return (prior
            .where((F.col("EncounterType") == prior_type)
                   & F.col("DischargeDate").isNotNull()
                   & F.col("PatientID").isNotNull())
            .select(F.col("PatientID").alias("dpid"),
                    F.col("DischargeDate").alias("dday"))
            .distinct())


def _bucketed_matches(starts: DataFrame, dis: DataFrame, w: int) -> DataFrame:
    """Rows of ``starts`` (``PatientID``, ``day``, any other columns) with a
    discharge day in ``[day - w, day - 1]``. The window is covered by at most
    two ``w``-day buckets, so the range join becomes an equi-join on
    ``(PatientID, bucket)`` with the range as a residual condition; a row
    matching in both buckets appears twice."""
    s_ep = F.unix_date("day")
    probes = starts.withColumn(
        "bucket", F.explode(F.sequence(F.floor((s_ep - w) / w), F.floor((s_ep - 1) / w))))
    dis_b = dis.withColumn("dbucket", F.floor(F.unix_date("dday") / w))
    cond = ((F.col("PatientID") == F.col("dpid"))
            & (F.col("bucket") == F.col("dbucket"))
            & (F.col("dday") < F.col("day"))
            & (F.col("dday") >= F.date_sub("day", w)))
    return probes.join(dis_b, cond, "left_semi").drop("bucket")


def readmission_day_counts(day_counts: DataFrame, prior: DataFrame,
                           window_days: int = READMISSION_WINDOW_DAYS,
                           prior_type: str = PRIOR_STAY_TYPE,
                           count: str = "_n") -> DataFrame:
    """The rows of ``day_counts`` — one per ``(PatientID, EncounterDate)``
    with a ``count`` column — whose day is a readmission day, count kept.

    The probe side is ``day_counts`` itself (no separate distinct of the start
    days), so a caller that also sums ``day_counts`` shares one aggregate and
    one scan of the encounters between both uses."""
    w = int(window_days)
    # No null filter here (it would make this branch's plan differ from the
    # caller's): a null patient never meets the join equality and a null day
    # yields no probe bucket, so such rows cannot match.
    starts = day_counts.select("PatientID", F.col("EncounterDate").alias("day"), count)
    if w < 1:
        return starts.where(F.lit(False)).select(
            "PatientID", F.col("day").alias("EncounterDate"), count)
    matched = _bucketed_matches(starts, _discharge_days(prior, prior_type), w)
    return (matched.groupBy("PatientID", "day").agg(F.max(count).alias(count))
            .withColumnRenamed("day", "EncounterDate"))


def readmission_days(encounters: DataFrame, prior: DataFrame | None = None,
                     window_days: int = READMISSION_WINDOW_DAYS,
                     prior_type: str = PRIOR_STAY_TYPE,
                     method: str = "bucketed",
                     distinct_days: bool = False) -> DataFrame:
    """Distinct ``(PatientID, EncounterDate)`` whose start falls in
    ``(discharge, discharge + window_days]`` of a closed prior stay.

    ``distinct_days=True`` declares that ``encounters`` already holds one row
    per ``(PatientID, EncounterDate)`` (e.g. an aggregate on those keys)."""
    prior = encounters if prior is None else prior
    starts = _start_days(encounters, distinct_days)
    dis = _discharge_days(prior, prior_type)
    w = int(window_days)
    if w < 1:
        return starts.where(F.lit(False)).select(
            "PatientID", F.col("day").alias("EncounterDate"))
    if method == "bucketed":
        hits = _bucketed_matches(starts, dis, w).select("PatientID", "day")
        return hits.distinct().withColumnRenamed("day", "EncounterDate")
    if method == "window":
        timeline = (starts.select("PatientID", "day", F.lit(1).alias("is_start"),
                                  F.lit(0).alias("is_dis"))
                    .unionByName(dis.select(F.col("dpid").alias("PatientID"),
                                            F.col("dday").alias("day"),
                                            F.lit(0).alias("is_start"),
                                            F.lit(1).alias("is_dis")))
                    .groupBy("PatientID", "day")
                    .agg(F.max("is_start").alias("is_start"),
                         F.max("is_dis").alias("is_dis")))
        win = (Window.partitionBy("PatientID").orderBy(F.unix_date("day"))
               .rangeBetween(-w, -1))
        return (timeline
                .withColumn("hit", F.max("is_dis").over(win))
                .where((F.col("is_start") == 1) & (F.col("hit") == 1))
                .select("PatientID", F.col("day").alias("EncounterDate")))
    raise ValueError(f"unknown method {method!r}")


# salt="auto": a (patient, day) holding more than 1/HOT_SHARE of all rows is
# hot and is split into ceil(rows * HOT_SHARE / all rows) <= HOT_SHARE parts.
# Fewer than HOT_SHARE keys can be hot, so the hot-key list is bounded by
# construction and is broadcast.
HOT_SHARE = 1000


def _flag_join_auto(encounters: DataFrame, cols: list[str], prior: DataFrame,
                    window_days: int, prior_type: str, method: str) -> DataFrame:
    keys = ["PatientID", "EncounterDate"]
    per_key = encounters.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hits = (readmission_days(per_key, prior, window_days, prior_type, method,
                             distinct_days=True)
            .withColumn("_readmit", F.lit(True)))
    total = per_key.select(F.sum("_rows")).scalar()  # scalar subquery
    hot = F.broadcast(
        per_key.where(F.col("_rows") * HOT_SHARE > total)
        .select(*keys, F.ceil(F.col("_rows") * HOT_SHARE / total).cast("int").alias("_parts")))
    hits = (hits.join(hot, keys, "left")
            .withColumn("_salt", F.explode(F.sequence(
                F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
            .drop("_parts"))
    rid = F.xxhash64("EncounterID")
    left = (encounters.select(*cols).join(hot, keys, "left")
            .withColumn("_salt", F.when(F.col("PatientID").isNull()
                                        | F.col("EncounterDate").isNull(),
                                        F.pmod(rid, F.lit(HOT_SHARE)))
                        .otherwise(F.pmod(rid, F.coalesce("_parts", F.lit(1)))))
            .drop("_parts"))
    return (left.join(hits, keys + ["_salt"], "left")
            .withColumn("IsReadmission", yes_no(F.col("_readmit")))
            .select(*cols, "IsReadmission"))


def with_readmission_flag(encounters: DataFrame, prior: DataFrame | None = None,
                          window_days: int = READMISSION_WINDOW_DAYS,
                          prior_type: str = PRIOR_STAY_TYPE,
                          method: str = "bucketed", salt: int | str = "auto") -> DataFrame:
    """+ ``IsReadmission`` (``'Yes'``/``'No'``).

    ``prior`` is the frame the prior stays are taken from (default: the same
    encounters); pass the full encounters when flagging a filtered subset.

    The flag is joined back on ``(PatientID, EncounterDate)``. Adaptive skew
    handling cannot split that join (the flag side ends in an aggregate), so the
    plan does: ``salt="auto"`` splits the hot keys, each in proportion to its
    share of the rows (see ``HOT_SHARE``), from counts taken in the same pass
    that finds the start days; rows with a null key, which cannot match, are
    spread by id. ``salt=n`` splits every key ``n`` ways instead (each matched
    day is replicated ``n`` times, each encounter picks one copy by a hash of its
    id); ``salt=1`` splits none.
    """
    cols = [c for c in encounters.columns if c != "IsReadmission"]
    if salt == "auto":
        return _flag_join_auto(encounters, cols, encounters if prior is None else prior,
                               window_days, prior_type, method)
    hits = (readmission_days(encounters, prior, window_days, prior_type, method)
            .withColumn("_readmit", F.lit(True)))
    keys = ["PatientID", "EncounterDate"]
    left = encounters.select(*cols)
    n = int(salt)
    if n > 1:
        hits = hits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        left = left.withColumn("_salt", F.pmod(F.xxhash64("EncounterID"), F.lit(n)))
        keys = keys + ["_salt"]
    return (left.join(hits, keys, "left")
            .withColumn("IsReadmission", yes_no(F.col("_readmit")))
            .select(*cols, "IsReadmission"))


def derive_model(tables: Tables, materialize_to: str | None = None,
                 method: str = "bucketed") -> Tables:
    """The model with its derived columns: encounters + ``LengthOfStayDays`` +
    ``IsReadmission``, patients + ``CatchmentArea`` (the source stores these
    once and every report reads them).

    With ``materialize_to`` (a folder in shared storage, e.g. under the
    session's ``spark.checkpoint.dir``) the two derived tables are written as
    Parquet and read back, so later reports reuse them instead of recomputing
    the readmission join, and their lineage is cut.
    """
    enc = with_readmission_flag(with_length_of_stay(tables.encounters), method=method)
    pts = with_catchment_area(tables.patients)
    if materialize_to:
        root = materialize_to.rstrip("/")
        spark = enc.sparkSession
        enc.write.mode("overwrite").parquet(f"{root}/encounters")
        pts.write.mode("overwrite").parquet(f"{root}/patients")
        enc = spark.read.schema(enc.schema).parquet(f"{root}/encounters")
        pts = spark.read.schema(pts.schema).parquet(f"{root}/patients")
    return replace(tables, encounters=enc, patients=pts)
