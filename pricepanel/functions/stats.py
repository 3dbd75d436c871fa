"""Statistical column expressions that stay inside JVM code generation.

ANSI mode is on in Spark 4, so every quotient uses ``try_divide``; the built-in
``corr`` raises on a constant column and is therefore composed from its parts.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd

from pyspark.sql import Column, functions as F


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; NULL when either side is constant."""
    xx = F.when(y.isNotNull(), x)
    yy = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def nan_to_null(x: Column) -> Column:
    """NaN is the file format's missing value; averages and medians need NULL."""
    return F.when(~F.isnan(x), x)


def null_count(x: Column) -> Column:
    return F.count_if(x.isNull())


def dot(weights: Column, values: Column) -> Column:
    """Inner product of two equally long DOUBLE arrays."""
    return F.aggregate(
        F.zip_with(weights, values, lambda a, b: a * b),
        F.lit(0.0).cast("double"),
        lambda acc, v: acc + v,
    )


def stars(p: Column) -> Column:
    """Significance marks at .001, .01 and .05."""
    return (
        F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")
    )


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def log_grid(lo: float, hi: float, n: int) -> Column:
    """``n`` powers of ten from 10**lo to 10**hi as one array column."""
    step = (hi - lo) / (n - 1)
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.pow(F.lit(10.0), F.lit(lo) + i * F.lit(step)),
    )


def kolmogorov_p(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value of the two-sample KS statistic.

    The alternating series converges fast for large lambda; its theta
    transform, used below one, converges fast for small lambda.
    """
    lam = d * F.sqrt(n1 * n2 / (n1 + n2))
    ks = F.sequence(F.lit(1), F.lit(terms))
    upper = F.aggregate(
        ks,
        F.lit(0.0).cast("double"),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    lower = F.aggregate(
        ks,
        F.lit(0.0).cast("double"),
        lambda acc, k: acc + F.exp(-((2 * k - 1) * (2 * k - 1)) * math.pi**2 / (8 * lam * lam)),
    )
    small = 1 - math.sqrt(2 * math.pi) / lam * lower
    p = F.when(lam <= 0, F.lit(1.0)).when(lam < 1, small).otherwise(upper)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), p))


def lattice_tail(n: int, m: int, h: int) -> float:
    """Share of the lattice paths from (0, 0) to (n, m) that reach a point with |i m - j n| >= h.

    Paths that stay inside are counted row by row; each one that leaves is
    counted at the point where it does, so small shares keep their digits.
    """
    if h <= 0:
        return 1.0
    if n > m:
        n, m = m, n
    fact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + m + 1)))])
    onward = lambda i, j: fact[n - i + m - j] - fact[n - i] - fact[m - j]
    total, tail = onward(0, 0), 0.0
    inside, scale, low = np.ones(1), 0.0, 0
    for i in range(n + 1):
        new_low = max((i * m - h) // n + 1, 0)
        high = min(-((-i * m - h) // n) - 1, m)
        if i:
            gone = np.arange(low, min(new_low, low + len(inside)))
            if len(gone):  # a step to the next row leaves
                with np.errstate(divide="ignore"):
                    share = np.log(inside[: len(gone)])
                tail += float(np.exp(share + onward(i, gone) - total + scale).sum())
            inside = inside[len(gone) :]
        low = new_low
        if high < low:
            break
        steps = np.zeros(high - low + 1)
        steps[: len(inside)] = inside
        inside = np.cumsum(steps)
        if high < m:  # a step along the row leaves
            with np.errstate(divide="ignore"):
                share = np.log(inside[-1])
            tail += float(np.exp(share + onward(i, high + 1) - total + scale))
        top = inside[-1]
        if top == 0:
            break
        inside, scale = inside / top, scale + np.log(top)
    return min(tail, 1.0)


def exact_kolmogorov_p(d: Column, n1: Column, n2: Column) -> Column:
    """Exact two-sided p-value of the two-sample KS statistic, for samples without ties.

    The work of a row is min(n1, n2) running sums of up to max(n1, n2) numbers.
    """

    def run(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
        empty = d.isna() | ~(n1 > 0) | ~(n2 > 0)
        rows = zip(empty, d, n1, n2)
        return pd.Series([None if e else lattice_tail(int(a), int(b), round(x * a * b)) for e, x, a, b in rows], dtype=float)

    return F.pandas_udf(run, "double")(d, n1, n2)
