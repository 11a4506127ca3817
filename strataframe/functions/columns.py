"""Column expressions: the NULL, division, rounding and random-draw rules of the library.

All of these are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (never Inf/NaN, never a DIVIDE_BY_ZERO error)."""
    return F.try_divide(col(a), col(b))


def any_null(*cols) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | col(c).isNull()
    return cond


def strict(agg: Column, *cols) -> Column:
    """Aggregate that is NULL as soon as one input row of ``cols`` is NULL (R's default)."""
    if not cols:
        return agg
    return F.when(F.count_if(any_null(*cols)) == 0, agg)


def agg_mean(c, skip_nulls: bool = False) -> Column:
    return F.avg(col(c)) if skip_nulls else strict(F.avg(col(c)), c)


def agg_sd(c, skip_nulls: bool = False) -> Column:
    return F.stddev_samp(col(c)) if skip_nulls else strict(F.stddev_samp(col(c)), c)


def agg_sum(c, skip_nulls: bool = False) -> Column:
    return F.sum(col(c)) if skip_nulls else strict(F.sum(col(c)), c)


def pair_corr(x, y) -> Column:
    """Pearson correlation over complete pairs; NULL for n < 2 or a constant column."""
    x, y = col(x), col(y)
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    vx, vy = F.var_samp(xx), F.var_samp(yy)
    return F.when((vx > 0) & (vy > 0), F.covar_samp(xx, yy) / F.sqrt(vx * vy))


def safe_corr(x, y, skip_nulls: bool = False) -> Column:
    """``cor(x, y)``: strict on NULLs unless ``skip_nulls``; NULL instead of an error."""
    r = pair_corr(x, y)
    return r if skip_nulls else strict(r, x, y)


def slope_moments(x, y) -> Column:
    """cor(x,y)·sd(y)/sd(x): the fitted slope, but NULL when y is constant."""
    return strict(F.when(F.var_samp(col(y)) > 0, F.regr_slope(col(y), col(x))), x, y)


def rnd(c, digits: int = 0) -> Column:
    """Round half to even, like R's ``round``."""
    return F.bround(col(c), digits)


def remove_first(c, pattern: str) -> Column:
    """Remove the first match of ``pattern`` only (``str_remove``)."""
    return F.regexp_replace(col(c), f"(?s)^(.*?)(?:{pattern})", "$1")


def text_or_na(c) -> Column:
    """Text of a value, with the literal ``NA`` for NULL (R's ``unite``)."""
    return F.coalesce(col(c).cast("string"), F.lit("NA"))


# ---------------------------------------------------------------- seeded hash draws
# A draw is a pure function of (seed, key): identical under task retry, repartitioning and
# in DuckDB (md5 + hex parse), which makes random operators checkable by SQL.
HASH_HEX_DIGITS = 13
HASH_SCALE = float(2 ** (4 * HASH_HEX_DIGITS))


def _digest(seed, *keys) -> Column:
    parts = [F.lit(str(seed))] + [col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def _hex_uniform(digest: Column, start: int) -> Column:
    h = F.conv(F.substring(digest, start, HASH_HEX_DIGITS), 16, 10).cast("bigint")
    return (h.cast("double") + 0.5) / F.lit(HASH_SCALE)


def uniform(seed, *keys) -> Column:
    """Uniform in (0, 1) from the first 13 hex digits of md5(seed:key...)."""
    return _hex_uniform(_digest(seed, *keys), 1)


def normal_pair(seed, *keys, mean: float = 0.0, sd: float = 1.0) -> tuple[Column, Column]:
    """Two independent normal draws from one md5: Box–Muller on hex digits 1-13 and 14-26."""
    d = _digest(seed, *keys)
    r = F.sqrt(F.lit(-2.0) * F.ln(_hex_uniform(d, 1)))
    t = F.lit(2.0 * math.pi) * _hex_uniform(d, 1 + HASH_HEX_DIGITS)
    return F.lit(mean) + F.lit(sd) * r * F.cos(t), F.lit(mean) + F.lit(sd) * r * F.sin(t)


def normal(seed, *keys, mean: float = 0.0, sd: float = 1.0) -> Column:
    """One normal draw (the cosine half of ``normal_pair``)."""
    return normal_pair(seed, *keys, mean=mean, sd=sd)[0]


def _digest_sql(seed, *key_sql: str) -> str:
    parts = " || ':' || ".join([f"'{seed}'"] + [f"cast({k} as varchar)" for k in key_sql])
    return f"md5({parts})"


def _hex_uniform_sql(digest: str, start: int) -> str:
    return (f"((('0x' || substr({digest}, {start}, {HASH_HEX_DIGITS}))::BIGINT)::DOUBLE + 0.5)"
            f" / {HASH_SCALE!r}")


def uniform_sql(seed, *key_sql: str) -> str:
    return _hex_uniform_sql(_digest_sql(seed, *key_sql), 1)


def normal_pair_sql(seed, *key_sql: str, mean: float = 0.0, sd: float = 1.0) -> tuple[str, str]:
    d = _digest_sql(seed, *key_sql)
    r = f"sqrt(-2.0 * ln({_hex_uniform_sql(d, 1)}))"
    t = f"({2.0 * math.pi!r} * {_hex_uniform_sql(d, 1 + HASH_HEX_DIGITS)})"
    return (f"({mean!r} + {sd!r} * {r} * cos({t}))", f"({mean!r} + {sd!r} * {r} * sin({t}))")


def normal_sql(seed, *key_sql: str, mean: float = 0.0, sd: float = 1.0) -> str:
    return normal_pair_sql(seed, *key_sql, mean=mean, sd=sd)[0]


# ---------------------------------------------------------------- normal quantile
# Coefficients of P. J. Acklam's published rational approximation of the
# inverse normal CDF (relative error below 1.2e-9).
ACKLAM_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
ACKLAM_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01)
ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00)
ACKLAM_LOW = 0.02425


def _horner(coefs: Iterable[float], x):
    acc = None
    for c in coefs:
        acc = F.lit(c) if acc is None else acc * x + F.lit(c)
    return acc


def norm_ppf(p) -> Column:
    """Inverse standard normal CDF as a Column expression (JVM side, no UDF)."""
    p = col(p)
    q = p - 0.5
    r = q * q
    central = _horner(ACKLAM_A, r) * q / (_horner(ACKLAM_B, r) * r + 1.0)
    ql = F.sqrt(F.lit(-2.0) * F.ln(p))
    lower = _horner(ACKLAM_C, ql) / (_horner(ACKLAM_D, ql) * ql + 1.0)
    qu = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - p))
    upper = -_horner(ACKLAM_C, qu) / (_horner(ACKLAM_D, qu) * qu + 1.0)
    return (F.when(p < ACKLAM_LOW, lower)
            .when(p > 1.0 - ACKLAM_LOW, upper)
            .otherwise(central))


def norm_ppf_sql(p: str) -> str:
    def horner(coefs, x):
        acc = repr(coefs[0])
        for c in coefs[1:]:
            acc = f"({acc} * {x} + {c!r})"
        return acc
    q = f"(({p}) - 0.5)"
    r = f"({q} * {q})"
    central = f"({horner(ACKLAM_A, r)} * {q} / ({horner(ACKLAM_B, r)} * {r} + 1.0))"
    ql = f"sqrt(-2.0 * ln({p}))"
    lower = f"({horner(ACKLAM_C, ql)} / ({horner(ACKLAM_D, ql)} * {ql} + 1.0))"
    qu = f"sqrt(-2.0 * ln(1.0 - ({p})))"
    upper = f"(-{horner(ACKLAM_C, qu)} / ({horner(ACKLAM_D, qu)} * {qu} + 1.0))"
    return (f"(case when ({p}) < {ACKLAM_LOW} then {lower} "
            f"when ({p}) > {1.0 - ACKLAM_LOW!r} then {upper} else {central} end)")
