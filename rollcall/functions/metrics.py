"""Attendance measures (P14, A18) and band labels (J7 as a generated CASE)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rate_pct(numer, denom, scale: int = 2) -> Column:
    """``round(100 * numer / nullif(denom, 0), scale)`` in exact decimal arithmetic.

    Inputs are cast to decimal so the ratio rounds half-up on the exact
    value (no binary floating point), and a zero denominator gives NULL
    instead of an ANSI divide-by-zero error.
    """
    n = _c(numer).cast("decimal(18,4)")
    d = _c(denom).cast("decimal(18,4)")
    return F.round(F.lit(100) * n / F.nullif(d, F.lit(0).cast("decimal(18,4)")), scale)


def chronic_absentee(rate, days_enrolled, threshold: Decimal, min_days: int) -> Column:
    """At or under the rate threshold with enough enrolled days."""
    return (_c(rate) <= F.lit(threshold)) & (_c(days_enrolled) >= F.lit(min_days))


def band_lookup(value, bands: list[tuple], value_index: int) -> Column:
    """J7 as a CASE over a small band table: ``lower < value <= upper``.

    ``bands`` are ``(lower, upper, *payload)`` tuples; returns payload
    ``value_index`` of the first matching band, else NULL.  A band table is a
    seed of a handful of rows, so a generated CASE replaces a nested-loop join.
    """
    v = _c(value)
    expr = None
    for lo, hi, *payload in bands:
        cond = (v > F.lit(lo)) & (v <= F.lit(hi))
        out = F.lit(payload[value_index])
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr if expr is not None else F.lit(None)
