"""Least-squares trend of yearly counts as one Column expression.

For fixed, known x values (the years) the OLS slope is linear in y:

    slope = (n * sum(x*y) - sum(x) * sum(y)) / (n * sum(x^2) - sum(x)^2)

With integer years and integer counts the numerator and denominator are
exact integers, so the only rounding is the final division: the value is
the same on every engine and every row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ols_slope(ys: Sequence[Column | str], xs: Sequence[int]) -> Column:
    """Slope of y over x for one row holding the y values in ``ys``."""
    if len(ys) != len(xs) or len(xs) < 2:
        raise ValueError("need the same number (>= 2) of y columns and x values")
    n = len(xs)
    sx = sum(xs)
    den = n * sum(x * x for x in xs) - sx * sx
    if den == 0:
        raise ValueError("x values must not all be equal")
    cols = [F.col(y) if isinstance(y, str) else y for y in ys]
    # integer weights: n*x_i - sum(x); slope = sum(w_i * y_i) / den
    num = None
    for x, y in zip(xs, cols):
        term = y.cast("bigint") * F.lit(n * x - sx)
        num = term if num is None else num + term
    return num.cast("double") / F.lit(float(den))


def ols_slope_long(y: Column | str, x: Column | str) -> Column:
    """Aggregate form for long data, one row per (key, x): ``regr_slope``."""
    return F.regr_slope(F.col(y) if isinstance(y, str) else y,
                        F.col(x) if isinstance(x, str) else x)


def rounded(c: Column, digits: int) -> Column:
    """Half-up rounding."""
    return F.round(c, digits)
