"""Tail probabilities of the chi-square and Student t distributions.

Spark SQL has neither, so a small Arrow UDF evaluates them on result rows (one row
per test), never on data rows.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Executors need not have this package installed: the functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EPS = 1e-15
_TINY = 1e-300
_STEPS = 100_000
# From here on series in 1/a are used; they are exact to many digits and need few terms.
_LARGE = 1e4


def _log_excess(m: float) -> float:
    """m - log(1 + m), without cancellation for small m."""
    if abs(m) > 0.1:
        return m - math.log1p(m)
    term, total, n = m * m, 0.0, 2
    while abs(term) > 1e-18 * max(abs(total), 1e-300) and n < 60:
        total += term / n if n % 2 == 0 else -term / n
        term *= m
        n += 1
    return total


def _gamma_upper_large(a: float, x: float) -> float:
    """Q(a, x) for large a: the uniform expansion around x = a.

    Fixed values: the first coefficients of the expansion, and their series near x = a.
    """
    m = (x - a) / a
    half = _log_excess(m)
    h = math.copysign(math.sqrt(2 * half), m)
    if abs(h) < 0.05:
        c0 = -1 / 3 + h / 12 - 2 * h**2 / 135 + h**3 / 864 + h**4 / 2835 - 139 * h**5 / 777600
        c1 = -1 / 540 - h / 288 + 25 * h**2 / 12096 - 223 * h**3 / 311040
    else:
        c0 = 1 / m - 1 / h
        c1 = 1 / h**3 - 1 / m**3 - 1 / m**2 - 1 / (12 * m)
    rest = math.exp(-a * half) / math.sqrt(2 * math.pi * a) * (c0 + c1 / a)
    return min(1.0, max(0.0, 0.5 * math.erfc(h * math.sqrt(a / 2)) + rest))


def _gamma_upper(a: float, x: float) -> float:
    """Regularized upper incomplete gamma function Q(a, x)."""
    if x <= 0:
        return 1.0
    if a >= _LARGE:
        return _gamma_upper_large(a, x)
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        for n in range(1, _STEPS):
            term *= x / (a + n)
            total += term
            if term < total * _EPS:
                return max(0.0, 1.0 - scale * total)
        raise ArithmeticError("the series did not converge")
    # Continued fraction b0 + a1/(b1 + a2/(b2 + ...)), b_n = x + 2n + 1 - a.
    return scale / _continued_fraction(
        lambda n: n * (a - n), lambda n: x + 2 * n + 1 - a
    )


def _beta_lower(a: float, b: float, x: float, y: float) -> float:
    """Regularized lower incomplete beta function I_x(a, b); ``y`` is 1 - x."""
    if x <= 0:
        return 0.0
    if y <= 0:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_lower(b, a, y, x)

    def numerator(n: int) -> float:
        m = n // 2
        if n % 2 == 0:
            return m * (b - m) * x / ((a + n - 1) * (a + n))
        return -(a + m) * (a + b + m) * x / ((a + n - 1) * (a + n))

    log_front = (
        a * math.log(x) + b * math.log(y)
        + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    )
    return math.exp(log_front) / (a * _continued_fraction(numerator, lambda n: 1.0))


def _continued_fraction(numerator, denominator) -> float:
    """Value of a continued fraction by the modified Lentz recurrence."""
    value = denominator(0) or _TINY
    c, d = value, 0.0
    for n in range(1, _STEPS):
        step, base = numerator(n), denominator(n)
        d = 1.0 / ((base + step * d) or _TINY)
        c = (base + step / c) or _TINY
        change = c * d
        value *= change
        if abs(change - 1.0) < _EPS:
            return value
    raise ArithmeticError("the continued fraction did not converge")


def chi_square_tail(statistic: float, dof: float) -> float:
    """P(X >= statistic) for a chi-square variable."""
    if dof <= 0:
        return 1.0
    return _gamma_upper(dof / 2.0, statistic / 2.0)


def _student_large(t: float, dof: float) -> float:
    """P(|T| >= |t|) for many degrees of freedom: the normal value of a series in t.

    Fixed values: the coefficients of the series.
    """
    a = dof - 0.5
    b = 48 * a * a
    w = math.sqrt(a * math.log1p(t * t / dof))
    z = (
        w + (w**3 + 3 * w) / b
        - (4 * w**7 + 33 * w**5 + 240 * w**3 + 855 * w) / (10 * b * b)
    )
    return math.erfc(z / math.sqrt(2))


def student_two_sided(t: float, dof: float) -> float:
    """P(|T| >= |t|) for a Student t variable."""
    if math.isinf(t):
        return 0.0
    if dof >= _LARGE:
        return _student_large(t, dof)
    return _beta_lower(dof / 2.0, 0.5, dof / (dof + t * t), t * t / (dof + t * t))


def _elementwise(fn, first: pd.Series, second: pd.Series) -> pd.Series:
    values = [
        None if pd.isna(a) or pd.isna(b) else fn(float(a), float(b))
        for a, b in zip(first, second)
    ]
    return pd.Series(values, dtype="float64")


@F.pandas_udf(DoubleType())
def chi_square_p(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return _elementwise(chi_square_tail, statistic, dof)


@F.pandas_udf(DoubleType())
def student_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _elementwise(student_two_sided, t, dof)
