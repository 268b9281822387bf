"""Predicates, classifiers and ordering helpers built from built-in functions."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def contains_any(col: Column | str, words: Iterable[str]) -> Column:
    """Substring match of any word without regard to case and accents (``LIKE
    '%w%'`` under the source's collation). ``%``, ``_`` and ``\\`` in words are
    literal. Accents can only matter in text beyond ASCII, which alone is
    compared by the (slower) collation."""
    c = F.collate(_c(col), "UTF8_BINARY")
    beyond = F.octet_length(c) != F.char_length(c)
    conds = []
    for w in words:
        esc = w.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
        conds.append(c.ilike(f"%{esc}%") | (beyond & F.contains(F.collate(c, "UNICODE_CI_AI"), F.lit(w))))
    if not conds:
        return F.lit(False)
    out = conds[0]
    for cond in conds[1:]:
        out = out | cond
    return out


def matches_lower(col: Column | str, pattern: str) -> Column:
    """Unanchored regular-expression search on the lower-cased value."""
    return F.lower(F.collate(_c(col), "UTF8_BINARY")).rlike(pattern)


def severity(value: Column | str, critical: float, elevated: float) -> Column:
    """Strictly above ``critical`` → critical, above ``elevated`` → elevated,
    else normal (a value equal to a cutoff falls to the lower class)."""
    v = _c(value)
    return (F.when(v > F.lit(critical), "critical")
             .when(v > F.lit(elevated), "elevated")
             .otherwise("normal"))


def value_order(col: Column | str, values: Sequence[str]) -> Column:
    """Position of the value in ``values`` (1-based), 0 when absent — the
    ordering key of ``ORDER BY FIELD(col, v1, v2, ...)``."""
    c = _c(col)
    out = F.lit(0)
    for i, v in reversed(list(enumerate(values, start=1))):
        out = F.when(c == F.lit(v), F.lit(i)).otherwise(out)
    return out


def label_by_lists(col: Column | str, mapping: Mapping[str, Sequence[str]],
                   default: str) -> Column:
    """First label whose list holds the value, else ``default`` (also for null)."""
    c = _c(col)
    items = list(mapping.items())
    if not items:
        return F.lit(default)
    label, vals = items[0]
    out = F.when(c.isin(list(vals)), F.lit(label))
    for label, vals in items[1:]:
        out = out.when(c.isin(list(vals)), F.lit(label))
    return out.otherwise(F.lit(default))


def in_period(col: Column | str, start: dt.date, end: dt.date) -> Column:
    """Inclusive date range (``BETWEEN``)."""
    return _c(col).between(F.lit(start), F.lit(end))


def yes_no(cond: Column) -> Column:
    """``'Yes'`` when the condition holds, else ``'No'`` (also when unknown)."""
    return F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))


def date_id_order(day: Column | str, key: Column | str) -> Column:
    """One exact ``decimal(38,0)`` that orders like the pair (day, key).

    ``unix_date(day) * 10^20 + (key + 2^63)`` keeps every long key in
    ``[0, 2^64) < 10^20``, so comparing the packed values compares the day
    first, then the key. Unlike a struct, a decimal is a fixed-width
    aggregation buffer, so ``min``/``min_by`` over it stay hash aggregates.
    """
    wide = "decimal(38,0)"
    d = F.unix_date(_c(day)).cast(wide)
    k = _c(key).cast(wide) + F.lit(Decimal(2 ** 63)).cast(wide)
    return d * F.lit(Decimal(10 ** 20)).cast(wide) + k
