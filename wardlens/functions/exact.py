"""Exact, order-independent arithmetic for money, rates and averages.

A distributed ``sum`` of doubles depends on the order in which partitions are
combined, so ``round(avg(x), 2)`` can flip at a ``.xx5`` boundary from one run to
the next. Money is therefore summed as decimals that keep the amounts' own
digits, integers as ``long``, and a result is rounded once, at the end, half away
from zero, on the (few) aggregated rows. Everything here is a built-in column
expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"
# Digits of an amount after and before the point.
_SCALE = 12
_AMOUNT = f"decimal(24,{_SCALE})"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount(value: Column | str) -> Column:
    """A money column as an exact decimal with the digits that its double is
    written with (``0.125``, not ``0.125000000000000007``): 12 digits after the
    point and 12 before it (a larger amount fails in ANSI mode)."""
    return _col(value).cast(_AMOUNT)


def times(value: Column | str, quantity: Column | str) -> Column:
    """``amount(value) * quantity`` for an integral quantity, exactly."""
    return amount(value) * _col(quantity).cast("decimal(13,0)")


def money(total: Column | str) -> Column:
    """A sum of amounts as ``double``, rounded to cents (``ROUND(SUM(x), 2)``)."""
    return F.round(_col(total), 2).cast("double")


def epoch_day(d: Column | str) -> Column:
    """Days since 1970-01-01 as ``int``; sums of these stay exact."""
    return F.unix_date(_col(d))


def half_up_div(num: Column | str, den: Column | str, digits: int) -> Column:
    """``round(num / den, digits)`` for integral ``num``/``den``, exactly.

    Ties round away from zero (``ROUND`` on exact values). Returns ``double``;
    null when ``den`` is null or not positive. Works on ``decimal(38,0)`` so
    products of large counts do not overflow.
    """
    n, d = _col(num).cast(_WIDE), _col(den).cast(_WIDE)
    scale = 10 ** digits
    a = F.abs(n) * F.lit(2 * scale) + d
    b = d * F.lit(2)
    q = (a - a % b) / b  # exact: a - a % b is a multiple of b
    signed = F.when(n < 0, -q).otherwise(q)  # exact; a zero result stays 0.0, not -0.0
    return F.when(d > 0, signed.cast("double") / scale)


def avg_half_up(total: Column | str, count: Column | str, digits: int) -> Column:
    """``ROUND(AVG(x), digits)`` from an exact integral total and a count."""
    return half_up_div(total, count, digits)


def avg_money(total: Column | str, count: Column | str, digits: int = 2) -> Column:
    """``ROUND(AVG(x), digits)`` from a sum of amounts and a count: both sides
    of the division are scaled to integers."""
    unit = F.lit(10 ** _SCALE).cast("decimal(13,0)")
    return half_up_div(_col(total) * unit, _col(count).cast("decimal(20,0)") * unit, digits)


def pct_half_up(part: Column | str, whole: Column | str, digits: int = 1) -> Column:
    """``ROUND(part * 100 / whole, digits)`` for counts."""
    return half_up_div(_col(part).cast(_WIDE) * 100, whole, digits)


def avg_diff_half_up(sum_a: Column | str, n_a: Column | str,
                     sum_b: Column | str, n_b: Column | str, digits: int) -> Column:
    """``ROUND(AVG(a) - AVG(b), digits)`` exactly, from integral sums and counts."""
    sa, na, sb, nb = (_col(x).cast(_WIDE) for x in (sum_a, n_a, sum_b, n_b))
    return F.when((na > 0) & (nb > 0),
                  half_up_div(sa * nb - sb * na, na * nb, digits))
