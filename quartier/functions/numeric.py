"""Sums that do not depend on order, and NaN-skipping extremes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timefns import js_round  # noqa: F401  (G23, display rounding)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A value is cut into a multiple of 2^-6, a multiple of 2^-28 and the rest.  Sums
# of the first two are exact in a double (up to 2^53 steps), and the rest is so
# small that the order of its additions does not reach the result's last bit.
_COARSE, _FINE = 2.0 ** 6, 2.0 ** 28
_LARGE = 2.0 ** 46


def sum_parts(col: Column | str) -> list[Column]:
    """The three addends of a value; NaN, inf and huge values are whole in the first."""
    x = _col(col)
    cut = F.abs(x) < _LARGE      # false for NaN and inf
    coarse = F.rint(x * _COARSE) / _COARSE
    fine = F.rint((x - coarse) * _FINE) / _FINE
    zero = F.when(x.isNotNull(), F.lit(0.0))
    return [F.when(cut, coarse).otherwise(x), F.when(cut, fine).otherwise(zero),
            F.when(cut, x - coarse - fine).otherwise(zero)]


def combine_sums(totals: Sequence[Column]) -> Column:
    """The sum from the totals of the three parts (0.0 over no values)."""
    a, b, c = (F.coalesce(t, F.lit(0.0)) for t in totals)
    return a + (b + c)


def exact_sum(col: Column | str) -> Column:
    """SUM of doubles that does not depend on the order of addition, so equal
    data give equal results under any partitioning.  Values keep their full
    precision; NaN and inf propagate; primitive buffers, so it hash-aggregates."""
    return combine_sums([F.sum(p) for p in sum_parts(col)])


def exact_avg(col: Column | str) -> Column:
    return exact_sum(col) / F.count(_col(col))


def max_number(col: Column | str) -> Column:
    """MAX that skips NaN unless every value is NaN."""
    c = _col(col)
    return F.coalesce(F.max(F.when(~F.isnan(c), c)), F.max(c))


def min_number(col: Column | str) -> Column:
    """MIN that skips NaN unless every value is NaN."""
    return F.min(_col(col))      # Spark orders NaN above every number
