"""Special functions for p-values and power, as vectorised pandas UDFs.

Spark SQL has no erf/erfc or incomplete beta function, so these few
functions run in Python over Arrow batches.  They are applied only to
already aggregated rows (one row per arm, metric or segment), never to
fact rows.  The plain NumPy versions are importable for unit tests.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# fixed value: two-sided 95% normal critical value, used for all CIs
Z_975 = 1.959963984540054

_erfc = np.vectorize(math.erfc, otypes=[float])
_ND = NormalDist()


def norm_sf(x):
    """Upper tail of the standard normal."""
    x = np.asarray(x, dtype=float)
    return 0.5 * _erfc(x / math.sqrt(2.0))


def norm_cdf(x):
    x = np.asarray(x, dtype=float)
    return 0.5 * _erfc(-x / math.sqrt(2.0))


def norm_ppf(p: float) -> float:
    return _ND.inv_cdf(p)


# fixed values: numerator and denominator of Hart's rational approximation to the normal tail, highest power first
_TAIL_UP = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931,
            220.206867912376)
_TAIL_DOWN = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831,
              793.826512519948, 440.413735824752)


def normal_pdf(x: Column) -> Column:
    """Density of the standard normal, for columns of any length."""
    return F.exp(-x * x / 2) / F.lit(math.sqrt(2 * math.pi))


def normal_cdf(x: Column) -> Column:
    """Distribution function of the standard normal as built-in expressions, for columns of any length (error below 1e-14)."""
    a = F.abs(x)
    up, down = F.lit(_TAIL_UP[0]), F.lit(_TAIL_DOWN[0])
    for c in _TAIL_UP[1:]:
        up = up * a + F.lit(c)
    for c in _TAIL_DOWN[1:]:
        down = down * a + F.lit(c)
    far = a + F.lit(0.65)
    for c in (4.0, 3.0, 2.0, 1.0):
        far = a + F.lit(c) / far
    e = F.exp(-a * a / 2)
    tail = F.when(a > 37, F.lit(0.0)).when(a < 7.07106781186547, e * up / down).otherwise(e / far / F.lit(math.sqrt(2 * math.pi)))
    return F.when(x > 0, 1 - tail).otherwise(tail)


def two_sided_normal_p(z):
    z = np.asarray(z, dtype=float)
    return _erfc(np.abs(z) / math.sqrt(2.0))


def chi2_1_sf(x):
    """Survival function of chi-square with one degree of freedom."""
    x = np.asarray(x, dtype=float)
    return _erfc(np.sqrt(np.maximum(x, 0.0) / 2.0))


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = tiny if abs(d) < tiny else d
    d = 1.0 / d
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1.0 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1.0 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    ln_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                + a * math.log(x) + b * math.log1p(-x))
    front = math.exp(ln_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def two_sided_t_p(t, df):
    """Two-sided p of Student's t with (possibly fractional) df."""
    t = np.asarray(t, dtype=float)
    df = np.asarray(df, dtype=float)
    out = np.full(t.shape, np.nan)
    for i, (tv, dv) in enumerate(zip(t.ravel(), df.ravel())):
        if np.isfinite(tv) and np.isfinite(dv) and dv > 0:
            out.ravel()[i] = betainc(dv / 2.0, 0.5, dv / (dv + tv * tv))
    return out


def normal_power(h, n1, n2, alpha: float = 0.05):
    """Two-sided power of a two-sample normal test for effect size ``h``."""
    h = np.asarray(h, dtype=float)
    nobs = 1.0 / (1.0 / np.asarray(n1, dtype=float) + 1.0 / np.asarray(n2, dtype=float))
    crit = norm_ppf(1 - alpha / 2)
    shift = h * np.sqrt(nobs)
    return norm_sf(crit - shift) + norm_cdf(-crit - shift)


def solve_effect_size(n1: float, n2: float, alpha: float = 0.05, power: float = 0.80) -> float:
    """Smallest |h| reaching ``power`` (bisection on the monotone power curve)."""
    lo, hi = 0.0, 1.0
    while normal_power(hi, n1, n2, alpha) < power and hi < 64:
        hi *= 2.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if normal_power(mid, n1, n2, alpha) < power:
            lo = mid
        else:
            hi = mid
        if hi - lo < 1e-15:
            break
    return 0.5 * (lo + hi)


def _nullable(values) -> pd.Series:
    s = pd.Series(np.asarray(values, dtype=float))
    return s.where(np.isfinite(s), None)


@F.pandas_udf(DoubleType())
def _p_normal_udf(z: pd.Series) -> pd.Series:
    return _nullable(two_sided_normal_p(z.astype(float).to_numpy()))


@F.pandas_udf(DoubleType())
def _p_chi2_udf(x: pd.Series) -> pd.Series:
    return _nullable(chi2_1_sf(x.astype(float).to_numpy()))


@F.pandas_udf(DoubleType())
def _p_t_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return _nullable(two_sided_t_p(t.astype(float).to_numpy(), df.astype(float).to_numpy()))


@F.pandas_udf(DoubleType())
def _power_udf(h: pd.Series, n1: pd.Series, n2: pd.Series, alpha: pd.Series) -> pd.Series:
    return _nullable([float(normal_power(a, b, c, d)) for a, b, c, d in zip(h, n1, n2, alpha)])


@F.pandas_udf(DoubleType())
def _mde_h_udf(n1: pd.Series, n2: pd.Series, alpha: pd.Series, power: pd.Series) -> pd.Series:
    return _nullable([solve_effect_size(a, b, c, d) for a, b, c, d in zip(n1, n2, alpha, power)])


def p_normal(z: Column) -> Column:
    return _p_normal_udf(z.cast("double"))


def p_chi2_1(x: Column) -> Column:
    return _p_chi2_udf(x.cast("double"))


def p_t(t: Column, df: Column) -> Column:
    return _p_t_udf(t.cast("double"), df.cast("double"))


def power(h: Column, n1: Column, n2: Column, alpha: float) -> Column:
    return _power_udf(h.cast("double"), n1.cast("double"), n2.cast("double"), F.lit(float(alpha)))


def mde_effect_size(n1: Column, n2: Column, alpha: float, target_power: float) -> Column:
    return _mde_h_udf(n1.cast("double"), n2.cast("double"), F.lit(float(alpha)), F.lit(float(target_power)))
