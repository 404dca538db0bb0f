"""Small closed-form statistics on a handful of numbers."""

from __future__ import annotations

import math


def f_upper_tail(f: float, df1: float, df2: float) -> float:
    """P(F(df1, df2) > f), the regularised incomplete beta at df2 / (df2 + df1 f)."""
    if math.isnan(f):
        return float("nan")
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    x = df2 / (df2 + df1 * f)
    a, b = df2 / 2.0, df1 / 2.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) if 0 < x < 1 else 0.0
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(x, a, b) / a
    return 1.0 - front * _beta_fraction(1 - x, b, a) / b


def _beta_fraction(x: float, a: float, b: float, tolerance: float = 1e-15, steps: int = 100_000) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz method)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, steps):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < tolerance:
            break
    return value
