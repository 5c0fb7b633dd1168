"""Numeric helpers (F3, F4) shared by the queries and the measures.

Rules that keep Spark and the SQL oracle bit-equal: money stays decimal(18,2)
until the final projection; ratios are computed in double and rounded, and a
``+ 0.0`` turns a rounded negative zero into zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: Column | str) -> Column:
    return _c(c).cast("double")


def div0(num: Column | str, den: Column | str) -> Column:
    """``num / NULLIF(den, 0)``; DAX ``DIVIDE`` (blank when the divisor is 0 or blank)."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def rnd(c: Column | str, scale: int) -> Column:
    """Round a double to ``scale`` places; ``+ 0.0`` folds -0.0 into 0.0."""
    return F.round(dbl(c), scale) + F.lit(0.0)


def pct_change(cur: Column | str, prev: Column | str, scale: int = 2) -> Column:
    """``ROUND(100.0 * (cur - prev) / NULLIF(prev, 0), scale)`` in double."""
    return rnd(F.lit(100.0) * (dbl(cur) - dbl(prev)) / F.nullif(dbl(prev), F.lit(0.0)), scale)


def millions(c: Column | str, scale: int = 2) -> Column:
    return rnd(dbl(c) / F.lit(1e6), scale)


def one_row(stats) -> Column:
    """A one-row aggregate as a struct-valued scalar subquery: ``one_row(st)["field"]``.

    Attaches global statistics to every row without a join; the subquery runs
    once and its value is inlined into each task.
    """
    return stats.select(F.struct(*[F.col(f"`{c}`") for c in stats.columns])).scalar()
