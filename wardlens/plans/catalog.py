"""Registered queries: every pipeline of the library run over the benchmark
tables (through the adapter), with fixed parameters so results are
reproducible and comparable with the SQL oracle."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.fixed_values import INFECTION_WORDS
from wardlens.functions.collation import collated, plain, with_collation
from wardlens.operators import (average_los, chronic_complications, claim_lag,
                                complaint_clusters, cost_by_type, costliest_stays,
                                denial_rate, duplicate_keys, expiry_watch,
                                foreign_key_report, infection_exposure,
                                inventory_value, key_report, length_report, low_stock,
                                not_null_report, referral_rejection, risk_tiers,
                                satisfaction_gap, vaccination_gaps,
                                with_catchment_area, with_length_of_stay,
                                with_readmission_flag)
from wardlens.plans.indicators import (bed_utilization_rate, compute_indicators,
                                       first_encounter_complication_rate,
                                       indicator_report, provider_workload_index,
                                       readmission_rate)
from wardlens.operators.patterns import rows_matching
from wardlens.plans.flags import FlagStore, replay_changes
from wardlens.plans.keyed import KeyedTable, replay_updates
from wardlens.plans.keyindex import KeyIndex, replay_batches
from wardlens.plans.periods import compute_indicators_periods, rolling_periods
from wardlens.plans.publish import publish_indicators, publish_periods, read_indicators
from wardlens.plans.states import REPORTS, ReportStates, replay_facts
from wardlens.session import shared_dir
from wardlens.sources.driver import SUPPLY_AS_OF, driver_tables
from wardlens.sources.model import Tables

# Fixed parameters of the registered queries.
PERIOD_START = dt.date(1996, 1, 1)
PERIOD_END = dt.date(1997, 12, 31)
COMPUTED_ON = dt.date(2026, 5, 15)

# Overlapping periods of six months, one starting in each month of three years.
PERIODS = rolling_periods(dt.date(1995, 1, 1), 36, 6)

_cache: dict[tuple[str, int, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Model tables of ``sf_dir`` (plans only; memoised per session)."""
    key = (spark.conf.get("spark.app.id", ""), id(spark), sf_dir)
    if key not in _cache:
        _cache[key] = driver_tables(spark, sf_dir)
    return _cache[key]


def _q(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tables(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _publish_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the period twice to the application's table in the shared folder and read
    it back: the rerun must leave exactly one copy of each row."""
    t = tables(spark, sf_dir)
    root = shared_dir(spark, f"quality_indicators-{spark.sparkContext.applicationId}")
    publish_indicators(compute_indicators(t, PERIOD_START, PERIOD_END, COMPUTED_ON), root,
                       PERIOD_START, PERIOD_END)
    publish_indicators(read_indicators(spark, root, PERIOD_START, PERIOD_END), root,
                       PERIOD_START, PERIOD_END)
    return read_indicators(spark, root, PERIOD_START, PERIOD_END)


def _new_root(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex}")


def _many_periods(t: Tables) -> DataFrame:
    """The indicators of 36 overlapping periods from one scan."""
    return compute_indicators_periods(t, PERIODS, COMPUTED_ON)


def _publish_many_periods(t: Tables) -> DataFrame:
    """36 periods published in one step, then some of them once more."""
    spark = t.encounters.sparkSession
    root = _new_root(spark, "periods")
    publish_periods(compute_indicators_periods(t, PERIODS, COMPUTED_ON), root, PERIODS)
    again = PERIODS[::5]
    publish_periods(compute_indicators_periods(t, again, COMPUTED_ON), root, again)
    return read_indicators(spark, root)


def _readmission_incremental(t: Tables) -> DataFrame:
    """The flags after a build and three batches of changes over all encounters."""
    spark = t.encounters.sparkSession
    store = FlagStore(spark, _new_root(spark, "flags"), buckets=16)
    return replay_changes(store, t.encounters).select(
        "EncounterID", "PatientID", "EncounterDate", "IsReadmission")


def _length_of_stay_updated(t: Tables) -> DataFrame:
    """Lengths of stay that updates by key have brought into a stored table."""
    rows = with_length_of_stay(t.encounters).select("EncounterID", "LengthOfStayDays")
    table = KeyedTable(t.encounters.sparkSession, _new_root(t.encounters.sparkSession, "keyed"),
                       rows.schema, "EncounterID", rows_per_range=20_000)
    return replay_updates(table, rows)


def _key_index(t: Tables) -> KeyIndex:
    """The index of all tables' keys, brought together in batches once."""
    if "_keys" not in t.__dict__:
        spark = t.encounters.sparkSession
        t._keys = KeyIndex(spark, _new_root(spark, "keys"), buckets=8)
        replay_batches(t._keys, t)
    return t._keys


def _respelled(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Two thirds of the rows with their text in capitals or with accents."""
    third = F.pmod(F.xxhash64(key), F.lit(3))
    return df.withColumns({c: F.when(third == 0, F.upper(c))
                           .when(third == 1, F.translate(c, "eaou", "éàöü")).otherwise(F.col(c))
                           for c in columns})


def _denial_rate_collated(t: Tables) -> DataFrame:
    """Denials whose status is spelled in three ways."""
    claims = _respelled(t.billing_claims, "ClaimID", "ClaimStatus")
    c = with_collation(replace(t, billing_claims=claims))
    return plain(denial_rate(c.billing_claims, c.encounters, c.departments))


def _referral_rejection_collated(t: Tables) -> DataFrame:
    """Referrals whose status and direction are spelled in three ways."""
    return plain(referral_rejection(collated(
        _respelled(t.referrals, "ReferralID", "Status", "ReferralDirection"))))


def _infection_exposure_collated(t: Tables) -> DataFrame:
    """Complaints with accents and capitals, found by the same words."""
    c = with_collation(replace(t, encounters=_respelled(t.encounters, "EncounterID", "ChiefComplaint")))
    return plain(infection_exposure(c.encounters, c.staff, c.departments))


def _infection_exposure_patterns(t: Tables) -> DataFrame:
    """Exposures whose complaints are found by a table of words."""
    words = t.encounters.sparkSession.createDataFrame([(w,) for w in INFECTION_WORDS], "pattern string")
    found = rows_matching(t.encounters, words, "ChiefComplaint")
    return infection_exposure(found, t.staff, t.departments)


def _from_states(name: str) -> Callable[[Tables], DataFrame]:
    """A report from states that were loaded, retracted and loaded again once
    for these tables."""
    def fn(t: Tables) -> DataFrame:
        spark = t.encounters.sparkSession
        if "_states" not in t.__dict__:
            t._states = ReportStates(spark, _new_root(spark, "states"))
            replay_facts(t._states, t)
        return t._states.report(name, t.departments)
    fn.__name__ = f"{name}_from_states"
    return fn


def _readmission(method: str) -> Callable[[Tables], DataFrame]:
    def fn(t: Tables) -> DataFrame:
        return with_readmission_flag(t.encounters, method=method).select(
            "EncounterID", "PatientID", "EncounterDate", "IsReadmission")
    fn.__name__ = f"readmission_flag_{method}"
    return fn


def _with_indicators(t: Tables) -> Tables:
    """The tables with the reporting table, as the checks cover it: published
    once for these tables, then read."""
    spark = t.encounters.sparkSession
    root = t.__dict__.get("_published")
    if root is None:
        root = _new_root(spark, "checked-indicators")
        publish_indicators(compute_indicators(t, PERIOD_START, PERIOD_END, COMPUTED_ON), root,
                           PERIOD_START, PERIOD_END)
        t._published = root
    return replace(t, quality_indicators=read_indicators(spark, root))


# Every registered query as a function of the model tables.
MODEL_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "low_stock": lambda t: low_stock(t.supplies, t.departments),
    "expiry_watch": lambda t: expiry_watch(t.supplies, t.departments, as_of=SUPPLY_AS_OF),
    "inventory_value": lambda t: inventory_value(t.supplies, t.departments),
    "complaint_clusters": lambda t: complaint_clusters(t.encounters),
    "vaccination_gaps": lambda t: vaccination_gaps(t.staff, t.departments),
    "infection_exposure": lambda t: infection_exposure(t.encounters, t.staff,
                                                      t.departments),
    "average_los": lambda t: average_los(t.encounters, t.departments),
    "referral_rejection": lambda t: referral_rejection(t.referrals),
    "cost_by_type": lambda t: cost_by_type(t.encounters),
    "claim_lag": lambda t: claim_lag(t.billing_claims, t.encounters, t.departments),
    "satisfaction_gap": lambda t: satisfaction_gap(t.satisfaction_surveys,
                                                  t.encounters, t.departments),
    "length_of_stay": lambda t: with_length_of_stay(t.encounters).select(
        "EncounterID", "LengthOfStayDays"),
    "readmission_flag": _readmission("bucketed"),
    "readmission_flag_window": _readmission("window"),
    "catchment_area": lambda t: with_catchment_area(t.patients).select(
        "PatientID", "Zip", "CatchmentArea"),
    "chronic_complications": lambda t: chronic_complications(t.encounters, t.patients),
    "denial_rate": lambda t: denial_rate(t.billing_claims, t.encounters, t.departments),
    "costliest_stays": lambda t: costliest_stays(t.encounters, t.departments),
    "risk_tiers": lambda t: risk_tiers(t.encounters, t.patients, t.billing_claims),
    "readmission_rate": lambda t: readmission_rate(
        t.encounters, t.patients, PERIOD_START, PERIOD_END, COMPUTED_ON),
    "first_encounter_complication_rate": lambda t: first_encounter_complication_rate(
        t.encounters, t.patients, PERIOD_START, PERIOD_END, COMPUTED_ON),
    "bed_utilization_rate": lambda t: bed_utilization_rate(
        t.encounters, t.departments, PERIOD_START, PERIOD_END, COMPUTED_ON),
    "provider_workload_index": lambda t: provider_workload_index(
        t.encounters, t.staff, PERIOD_START, PERIOD_END, COMPUTED_ON),
    "all_indicators": lambda t: compute_indicators(t, PERIOD_START, PERIOD_END,
                                                  COMPUTED_ON),
    "indicator_report": lambda t: indicator_report(
        compute_indicators(t, PERIOD_START, PERIOD_END, COMPUTED_ON), t.departments),
    "duplicate_keys": lambda t: duplicate_keys(
        t.supplies, ["DepartmentID", F.lower("SupplyName").alias("SupplyName")],
        nulls_are_violations=False),
    "orphans": lambda t: foreign_key_report(_with_indicators(t)),
    "null_violations": lambda t: not_null_report(_with_indicators(t)),
    "length_violations": lambda t: length_report(_with_indicators(t)),
    "key_report": lambda t: key_report(_with_indicators(t)),
    "infection_exposure_patterns": _infection_exposure_patterns,
    "denial_rate_collated": _denial_rate_collated,
    "referral_rejection_collated": _referral_rejection_collated,
    "infection_exposure_collated": _infection_exposure_collated,
    "indicators_many_periods": _many_periods,
    "publish_many_periods": _publish_many_periods,
    "readmission_flag_incremental": _readmission_incremental,
    "length_of_stay_updated": _length_of_stay_updated,
    "key_report_incremental": lambda t: _key_index(t).key_report(),
    "orphans_incremental": lambda t: _key_index(t).foreign_key_report(),
}

MODEL_QUERIES |= {f"{name}_from_states": _from_states(name) for name in REPORTS}

# Queries that write tables, and so start jobs before their result is read.
WRITING = {"publish_rerun", "indicators_many_periods", "publish_many_periods",
           "readmission_flag_incremental", "length_of_stay_updated", "key_report_incremental", "orphans_incremental",
           "orphans", "null_violations", "length_violations", "key_report",
           *[f"{name}_from_states" for name in REPORTS]}

# The registered queries as the driver calls them: (session, benchmark folder).
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
for _name, _fn in MODEL_QUERIES.items():
    QUERIES[_name] = _q(_fn)
    if _name == "all_indicators":
        QUERIES["publish_rerun"] = _publish_rerun

FLAGSHIP = "all_indicators"
