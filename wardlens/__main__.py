"""Batch entry point (``spark-submit -m wardlens …`` or ``python -m wardlens …``).

    derive --tables ROOT --out ROOT2
    report NAME --tables ROOT [--derived] [--fmt parquet] [--as-of DATE] [--n N]
           [--department-id ID] [--min-claims N] [--k K] [--out PATH]
    indicators --tables ROOT [--derived] --start DATE --end DATE --publish ROOT2
               [--computed-on DATE] [--materialize-to PATH]
    checks --tables ROOT [--out PATH]

``--tables`` holds one folder per model table (``ROOT/encounters`` …).
``derive`` writes the model with its derived columns (length of stay,
readmission flag, catchment area) to ``--out``; ``--derived`` reads such stored
columns and uses them. All rows of a result are printed, or written as Parquet to ``--out``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from dataclasses import replace

from wardlens import operators as ops
from wardlens.plans import (compute_indicators, indicator_report, publish_indicators,
                            read_indicators)
from wardlens.session import build_session
from wardlens.sources import read_tables, write_tables

def _given(a, *names: str) -> dict:
    """The report parameters that were given on the command line."""
    return {n: getattr(a, n) for n in names if getattr(a, n) is not None}


def _n(a) -> dict:
    """--n 0 lifts the report's limit."""
    return {} if a.n is None else {"n": a.n or None}


REPORTS = {
    "low_stock": lambda t, a: ops.low_stock(t.supplies, t.departments, **_n(a)),
    "expiry_watch": lambda t, a: ops.expiry_watch(t.supplies, t.departments, as_of=a.as_of, **_n(a)),
    "inventory_value": lambda t, a: ops.inventory_value(t.supplies, t.departments, **_n(a)),
    "complaint_clusters": lambda t, a: ops.complaint_clusters(
        t.encounters, **_given(a, "department_id"), **_n(a)),
    "vaccination_gaps": lambda t, a: ops.vaccination_gaps(t.staff, t.departments, **_n(a)),
    "infection_exposure": lambda t, a: ops.infection_exposure(t.encounters, t.staff,
                                                              t.departments, **_n(a)),
    "average_los": lambda t, a: ops.average_los(t.encounters, t.departments),
    "referral_rejection": lambda t, a: ops.referral_rejection(t.referrals),
    "cost_by_type": lambda t, a: ops.cost_by_type(t.encounters),
    "claim_lag": lambda t, a: ops.claim_lag(t.billing_claims, t.encounters, t.departments, **_n(a)),
    "satisfaction_gap": lambda t, a: ops.satisfaction_gap(t.satisfaction_surveys,
                                                          t.encounters, t.departments),
    "chronic_complications": lambda t, a: ops.chronic_complications(t.encounters, t.patients),
    "denial_rate": lambda t, a: ops.denial_rate(t.billing_claims, t.encounters,
                                                t.departments, **_given(a, "min_claims")),
    "costliest_stays": lambda t, a: ops.costliest_stays(t.encounters, t.departments,
                                                        **_given(a, "k")),
    "risk_tiers": lambda t, a: ops.risk_tiers(t.encounters, t.patients, t.billing_claims, **_n(a)),
}


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def _emit(df, out: str | None) -> None:
    if out:
        df.write.mode("overwrite").parquet(out)
        return
    # All rows, one partition in the driver at a time.
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None, spark=None) -> int:
    """Run one command; a given ``spark`` session is used and left running."""
    p = argparse.ArgumentParser(prog="wardlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("report")
    r.add_argument("name", choices=sorted(REPORTS))
    r.add_argument("--as-of", type=_date, default=None)
    r.add_argument("--n", type=int, default=None, help="rows of a top list; 0: all")
    r.add_argument("--department-id", type=int, default=None)
    r.add_argument("--min-claims", type=int, default=None)
    r.add_argument("--k", type=int, default=None, help="ranks per department")
    i = sub.add_parser("indicators")
    i.add_argument("--start", type=_date, required=True)
    i.add_argument("--end", type=_date, required=True)
    i.add_argument("--publish", required=True)
    i.add_argument("--computed-on", type=_date, default=None)
    i.add_argument("--materialize-to", default=None, help="shared folder for the period's rows")
    c = sub.add_parser("checks")
    d = sub.add_parser("derive")
    for sp in (r, i, c, d):
        sp.add_argument("--tables", required=True)
        sp.add_argument("--fmt", default="parquet")
        sp.add_argument("--out", default=None, required=sp is d)
    for sp in (r, i):
        sp.add_argument("--derived", action="store_true")
    a = p.parse_args(argv)

    own = spark is None
    spark = spark or build_session()
    t = read_tables(spark, a.tables, fmt=a.fmt, missing_ok=True,
                    with_derived=getattr(a, "derived", False))
    if a.cmd == "derive":
        out = a.out.rstrip("/")
        derived = ops.derive_model(t, materialize_to=out)
        write_tables(replace(derived, encounters=None, patients=None), out)
    elif a.cmd == "report":
        _emit(REPORTS[a.name](t, a), a.out)
    elif a.cmd == "indicators":
        ind = compute_indicators(t, a.start, a.end, a.computed_on or dt.date.today(),
                                 materialize_to=a.materialize_to)
        publish_indicators(ind, a.publish, a.start, a.end)
        _emit(indicator_report(read_indicators(spark, a.publish, a.start, a.end),
                               t.departments), a.out)
    else:
        for name, df in (("primary and unique keys", ops.key_report(t)),
                         ("foreign keys", ops.foreign_key_report(t)),
                         ("not null", ops.not_null_report(t)),
                         ("string lengths", ops.length_report(t))):
            print(f"== {name}")
            _emit(df, f"{a.out}/{name.replace(' ', '_')}" if a.out else None)
    if own:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
