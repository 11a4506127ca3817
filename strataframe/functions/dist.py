"""Tail probabilities and quantiles of t, F and chi-square, vectorised with numpy.

They run inside ``mapInPandas`` tasks on moment rows (one row per fitted group), never on
data rows.  The regularised incomplete beta uses the continued fraction of DLMF 8.17.22,
evaluated with the modified Lentz method.
"""

from __future__ import annotations

import math

import numpy as np

MANY_DF = 1e7
_TINY = 1e-300
_EPS = 1e-15
_MAX_ITER = 100_000  # steps grow with the root of the larger parameter near the mean


def _lgamma(x):
    return np.vectorize(math.lgamma, otypes=[float])(x)


def _stirling(z):
    """log gamma(z) minus its leading terms, for z of 50 and more."""
    w = 1.0 / (z * z)
    return (1.0 / 12.0 - w * (1.0 / 360.0 - w * (1.0 / 1260.0 - w / 1680.0))) / z


def _log_beta(a, b):
    """log B(a, b), also where one argument is so large that log gammas would cancel."""
    small, large = np.minimum(a, b), np.maximum(a, b)
    far = large >= 50.0
    safe = np.where(far, large, 50.0)
    total = safe + small
    ratio = (small * np.log(total) + (safe - 0.5) * np.log1p(small / safe) - small
             + _stirling(total) - _stirling(safe))  # log gamma(large + small) - log gamma(large)
    both = _lgamma(np.where(far, 1.0, a)) + _lgamma(np.where(far, 1.0, b)) - _lgamma(np.where(far, 2.0, a + b))
    return np.where(far, _lgamma(small) - ratio, both)


def _betacf(a, b, x):
    """Continued fraction for I_x(a, b), valid for x < (a+1)/(a+b+2)."""
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < _TINY, _TINY, d)
    d = 1.0 / d
    h = d.copy()
    done = np.zeros(x.shape, dtype=bool)
    for m in range(1, _MAX_ITER + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        h = np.where(done, h, h * d * c)
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        delta = d * c
        h = np.where(done, h, h * delta)
        done |= np.abs(delta - 1.0) < _EPS
        if done.all():
            return h
    raise ArithmeticError("the continued fraction of the incomplete beta did not converge")


def betainc(a, b, x, y=None):
    """Regularised incomplete beta I_x(a, b), elementwise; NaN where inputs are NaN. ``y`` is 1 - x
    where the caller knows it better than that difference does."""
    y = 1.0 - np.asarray(x, float) if y is None else y
    a, b, x, y = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float),
                                     np.asarray(x, float), np.asarray(y, float))
    a, b, x, y = a.copy(), b.copy(), x.copy(), y.copy()
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0)
    out[ok & (x <= 0)] = 0.0
    out[ok & (y <= 0)] = 1.0
    mid = ok & (x > 0) & (y > 0)
    if not mid.any():
        return out
    am, bm, xm, ym = a[mid], b[mid], x[mid], y[mid]
    log = lambda p, q: np.where(q < 0.5, np.log1p(-q), np.log(p))  # noqa: E731  of p, with q = 1 - p
    front = np.exp(am * log(xm, ym) + bm * log(ym, xm) - _log_beta(am, bm))
    direct = xm < (am + 1.0) / (am + bm + 2.0)
    res = np.empty_like(xm)
    if direct.any():
        res[direct] = front[direct] * _betacf(am[direct], bm[direct], xm[direct]) / am[direct]
    flip = ~direct
    if flip.any():
        res[flip] = 1.0 - front[flip] * _betacf(bm[flip], am[flip], ym[flip]) / bm[flip]
    out[mid] = res
    return out


def t_two_sided_p(t, df):
    """P(|T| > |t|) for Student's t with ``df`` degrees of freedom."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    with np.errstate(invalid="ignore", divide="ignore"):
        many = df >= MANY_DF
        few = np.where(many, 1.0, df)
        p = betainc(few / 2.0, 0.5, few / (few + t * t), t * t / (few + t * t))
        # so many degrees of freedom: the normal law, with an error of the order of 1 / df ** 2
        z = np.sqrt(df * np.log1p(t * t / df)) * (1.0 - 0.25 / df)
        p = np.where(many, np.vectorize(math.erfc, otypes=[float])(np.nan_to_num(z) / math.sqrt(2.0)), p)
    return np.where(np.isfinite(t) & (df > 0), p, np.nan)


def t_cdf(t, df):
    p2 = t_two_sided_p(t, df)
    return np.where(t >= 0, 1.0 - p2 / 2.0, p2 / 2.0)


def t_quantile(p, df):
    """Quantile of Student's t (upper half, p >= 0.5) by bracketing + bisection."""
    df = np.asarray(df, float)
    p = np.broadcast_to(np.asarray(p, float), df.shape).copy()
    ok = np.isfinite(df) & (df > 0)
    lo = np.zeros(df.shape)
    hi = np.ones(df.shape)
    for _ in range(80):
        need = ok & (t_cdf(hi, np.where(ok, df, 1.0)) < p)
        if not need.any():
            break
        lo = np.where(need, hi, lo)
        hi = np.where(need, hi * 2.0, hi)
    dfe = np.where(ok, df, 1.0)
    for _ in range(100):
        mid = 0.5 * (lo + hi)
        below = t_cdf(mid, dfe) < p
        lo = np.where(below, mid, lo)
        hi = np.where(below, hi, mid)
    return np.where(ok, 0.5 * (lo + hi), np.nan)


def f_upper_p(f, d1, d2):
    """P(F > f) for the F distribution with (d1, d2) degrees of freedom."""
    f, d1, d2 = (np.asarray(v, float) for v in (f, d1, d2))
    with np.errstate(invalid="ignore", divide="ignore"):
        p = betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f), d1 * f / (d2 + d1 * f))
    return np.where(np.isfinite(f) & (d1 > 0) & (d2 > 0), p, np.nan)


def chi2_1df_upper_p(x):
    """P(X > x) for chi-square with one degree of freedom: erfc(sqrt(x/2))."""
    x = np.asarray(x, float)
    return np.array([math.erfc(math.sqrt(v / 2.0)) if np.isfinite(v) and v >= 0 else np.nan
                     for v in np.atleast_1d(x)])
