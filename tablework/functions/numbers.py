"""Arithmetic and array expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(top: Column | str, bottom: Column | str) -> Column:
    """Quotient, null where the divisor is zero."""
    return _col(top) / F.nullif(_col(bottom), F.lit(0))


def pct_change(now: Column | str, before: Column | str) -> Column:
    """Change in percent of the earlier value; null for a missing or zero base."""
    return safe_div(_col(now) - _col(before), before) * 100


def leverage(equity_percent: Column | str) -> Column:
    """Debt to equity from the equity share in percent."""
    share = _col(equity_percent) / 100
    return safe_div(1 - share, share)


def reverse_bits(c: Column | str, width: int = 32) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(_col(c)), width, "0")), 2, 10).cast("bigint")


def weighted_sum(values: Column | str, weights: list[float]) -> Column:
    """Dot product of an array column with a fixed vector."""
    pairs = F.zip_with(_col(values), F.array(*[F.lit(float(w)) for w in weights]), lambda v, w: v.cast("double") * w)
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x)


def every_nth(values: Column | str, n: int) -> Column:
    return F.filter(_col(values), lambda v, i: i % n == 0)


def grid(start: float, stop: float, points: int) -> Column:
    """Evenly spaced numbers, both ends included."""
    step = (stop - start) / (points - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.lit(float(start)) + i * F.lit(step))
