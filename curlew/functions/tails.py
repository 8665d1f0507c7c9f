"""Upper-tail probabilities of the F and studentized-range distributions in
numpy (no scipy here). Used inside pandas UDFs over a handful of rows per
(descriptor, metric) group."""

from __future__ import annotations

import math

import numpy as np


def _betacf(a: float, b: float, x: float, itmax: int = 400, eps: float = 1e-15) -> float:
    """Continued fraction for the incomplete beta (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, itmax + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def f_sf(f: float, df1: float, df2: float) -> float:
    """P(F > f) for F(df1, df2)."""
    if f is None or not np.isfinite(f) or df1 <= 0 or df2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * f))


_GL_X, _GL_W = np.polynomial.legendre.leggauss(96)
_erf = np.vectorize(math.erf)


def _phi_cdf(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + _erf(z / math.sqrt(2.0)))


def _range_cdf(w: np.ndarray, k: int) -> np.ndarray:
    """P(range of k iid standard normals <= w), for an array of w."""
    lo, hi = -8.0, 8.0
    z = 0.5 * (hi - lo) * _GL_X + 0.5 * (hi + lo)
    wz = 0.5 * (hi - lo) * _GL_W
    pdf = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    cz = _phi_cdf(z)
    w = np.atleast_1d(w)
    inner = cz[None, :] - _phi_cdf(z[None, :] - w[:, None])
    return k * np.sum(wz[None, :] * pdf[None, :] * np.power(np.clip(inner, 0, 1), k - 1), axis=1)


def studentized_range_sf(q: float, k: int, df: float) -> float:
    """P(Q > q) for the studentized range with k groups and df error
    degrees of freedom (quadrature over the scaled chi density)."""
    if q is None or not np.isfinite(q) or k < 2 or df <= 0:
        return float("nan")
    if q <= 0:
        return 1.0
    # s = sqrt(chi2_df / df): integrate f_s(s) * P(range > q s) over a width that
    # shrinks with df; f_s is scaled by its own integral, so large df lose no digits
    width = 12 / math.sqrt(2 * df)
    lo, hi = max(1e-6, 1 - width), 1 + width
    s = 0.5 * (hi - lo) * _GL_X + 0.5 * (hi + lo)
    log_dens = (df - 1) * np.log(s) - df * (s * s - 1) / 2
    weight = _GL_W * np.exp(log_dens - log_dens.max())
    cdf = float(np.sum(weight * _range_cdf(q * s, k)) / np.sum(weight))
    return min(1.0, max(0.0, 1.0 - cdf))
