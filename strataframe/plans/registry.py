"""Registry of named queries and their DuckDB oracle SQL.

Each query takes (spark, sf_dir) and returns a DataFrame. Doubles are rounded the same way
on both sides, so the two engines hash identically: to nine significant digits, in steps of
1e-11 at least, p-values to nine significant digits however small (plus 0.0 to fold negative zero).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from strataframe.session import ship_package
from strataframe.sources.fixtures import with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: Significant digits that are compared, and decimals at most: beyond them two engines' sums differ.
SIG_DIGITS, DECIMALS = 9, 11
#: Decimals of columns that no difference of sums goes into, by the end of their name.
TAILS, TAIL_DECIMALS = "p_value", 300


def _decimals(name: str) -> int:
    return TAIL_DECIMALS if name.endswith(TAILS) else DECIMALS


def round_double(c, decimals: int = DECIMALS):
    """Nine significant digits at every magnitude, ``decimals`` at most; -0.0 becomes 0.0.

    Plain double arithmetic (half away from zero) on whole powers of ten, written identically in
    the SQL twin so both engines perform the same IEEE operations.
    """
    places = F.least(SIG_DIGITS - 1 - F.floor(F.log10(F.abs(c))), F.lit(decimals))
    up, down = F.pow(F.lit(10.0), F.greatest(places, F.lit(0))), F.pow(F.lit(10.0), F.greatest(-places, F.lit(0)))
    rounded = F.signum(c) * (F.floor(F.abs(c) * up / down + 0.5) * down / up)
    return F.when(c == 0, F.lit(0.0)).otherwise(rounded) + F.lit(0.0)


def round_double_sql(c: str, decimals: int = DECIMALS) -> str:
    places = f"least({SIG_DIGITS - 1} - floor(log10(abs({c}))), {decimals})"
    up, down = f"pow(10.0, greatest({places}, 0))", f"pow(10.0, greatest(-({places}), 0))"
    return (f"(case when {c} = 0 then 0.0 else sign({c}) * (floor(abs({c}) * {up} / {down} + 0.5) * {down} / {up}) end"
            " + 0.0)")


def finish(df: DataFrame) -> DataFrame:
    """Round every double column (``round_double``)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(round_double(c.cast("double"), _decimals(f.name)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def oracle(main: str, doubles: Sequence[str] | str = (), ctes: dict | None = None) -> str:
    """Wrap ``main`` with the fixture/extra CTEs it uses and the same rounding as ``finish``."""
    if isinstance(doubles, str):
        doubles = doubles.split()
    if doubles:
        rep = ", ".join(f'{round_double_sql(chr(34) + c + chr(34), _decimals(c))} as "{c}"' for c in doubles)
        main = f"select * replace ({rep}) from (\n{main}\n) _q"
    return with_fixtures(main, ctes)


def register(name: str, sql: str | None = None, doubles: Sequence[str] | str = (),
             ctes: dict | None = None):
    """Decorator: register a Spark query and (optionally) its oracle SQL."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return finish(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = oracle(sql, doubles, ctes)
        return fn
    return deco


# ---------------------------------------------------------------- OLS in SQL (oracle only)
def ols_sql_ctes(prefix: str, src: str, y: str, xs: Sequence[str],
                 by: Sequence[str] = ()) -> dict[str, str]:
    """CTEs computing a full-rank OLS per group in SQL by sweeping the centred
    cross-product matrix; the last CTE ``{prefix}_fit`` has by..., n, means (m_i),
    the swept matrix (a_i_j) and the residual variance (s2).

    Index 0..k-1 are the predictors and k is the response.
    """
    k = len(xs)
    cols = [*xs, y]
    byl = ", ".join(f'"{b}"' for b in by)
    byc = (byl + ", ") if by else ""
    mom = [f"count(*) as n"]
    mom += [f'avg("{c}") as m_{i}' for i, c in enumerate(cols)]
    mom += [f'coalesce(covar_samp("{a}", "{b}"), 0.0) as c_{i}_{j}'
            for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]
    where = " and ".join(f'"{c}" is not null' for c in cols)
    ctes = {f"{prefix}_m0": f"select {byc}{', '.join(mom)} from {src} where {where}"
                            + (f" group by {byl}" if by else "")}
    m = k + 1
    keep = [*[f'"{b}"' for b in by], "n", f"c_{k}_{k}", *[f"m_{i}" for i in range(m)]]
    first = [f"c_{min(i, j)}_{max(i, j)} * (n - 1) as a_{i}_{j}" for i in range(m) for j in range(m)]
    ctes[f"{prefix}_s0"] = f"select {', '.join(keep)}, {', '.join(first)} from {prefix}_m0"
    for p in range(k):
        d = f"a_{p}_{p}"
        exprs = []
        for i in range(m):
            for j in range(m):
                if i == p and j == p:
                    e = f"1.0 / {d}"
                elif i == p:
                    e = f"a_{p}_{j} / {d}"
                elif j == p:
                    e = f"-a_{i}_{p} / {d}"
                else:
                    e = f"a_{i}_{j} - a_{i}_{p} * a_{p}_{j} / {d}"
                exprs.append(f"{e} as a_{i}_{j}")
        ctes[f"{prefix}_s{p + 1}"] = (f"select {', '.join(keep)}, {', '.join(exprs)} "
                                      f"from {prefix}_s{p}")
    ctes[f"{prefix}_fit"] = (
        f"select *, case when n - {k} - 1 > 0 then greatest(a_{k}_{k}, 0.0) / (n - {k} - 1) end"
        f" as s2, greatest(a_{k}_{k}, 0.0) as rss, c_{k}_{k} * (n - 1) as tss from {prefix}_s{k}")
    return ctes


def ols_sql_intercept(k: int) -> tuple[str, str]:
    """(estimate, std_error) SQL expressions of the intercept on a ``*_fit`` row."""
    est = f"m_{k}" + "".join(f" - a_{j}_{k} * m_{j}" for j in range(k))
    quad = " + ".join(f"m_{i} * m_{j} * a_{i}_{j}" for i in range(k) for j in range(k)) or "0"
    se = f"sqrt(s2 * (1.0 / n + {quad}))"
    return est, se


def ols_sql_tidy(prefix: str, xs: Sequence[str], by: Sequence[str] = (),
                 intercept: str = "(Intercept)") -> str:
    """term, estimate, std_error, statistic per group from ``{prefix}_fit``."""
    k = len(xs)
    byc = "".join(f'"{b}", ' for b in by)
    est, se = ols_sql_intercept(k)
    parts = [f"select {byc}'{intercept}' as term, {est} as estimate, {se} as std_error, "
             f"({est}) / nullif({se}, 0) as statistic from {prefix}_fit"]
    for j, x in enumerate(xs):
        se_j = f"sqrt(s2 * a_{j}_{j})"
        parts.append(f"select {byc}'{x}' as term, a_{j}_{k} as estimate, {se_j} as std_error, "
                     f"a_{j}_{k} / nullif({se_j}, 0) as statistic from {prefix}_fit")
    return "\nunion all\n".join(parts)


# ---------------------------------------------------------------- tails in SQL (oracle only)
def t_p_sql(t: str, df: str) -> str:
    """P(|T| > |t|) for whole degrees of freedom, to small relative error: the series of positive terms of the
    incomplete beta where it converges fast, which is where the tail is thin; else one minus the finite series."""
    x = f"(-ln(1 + ({t}) * ({t}) / ({df})))"  # log of df / (df + t * t)
    a = f"({df} / 2.0)"
    front = (f"exp({a} * {x} + 0.5 * (ln(({t}) * ({t}) / ({df})) + {x}) - ln({a}) - lgamma({a}) - lgamma(0.5::double) + lgamma({a} + 0.5))")
    series = (f"list_sum(list_transform(range(0, 20000), lambda j: exp(lgamma({a} + 0.5 + j) - lgamma({a} + 0.5) "
              f"- lgamma({a} + 1 + j) + lgamma({a} + 1) + j * {x})))")
    return f"(case when ({t}) * ({t}) > 0.002 * ({df}) then {front} * {series} else {t_p_middle_sql(t, df)} end)"


def t_p_middle_sql(t: str, df: str) -> str:
    """P(|T| > |t|) for whole degrees of freedom, to small absolute error: the finite series in the cosine of the
    angle whose tangent is |t| / sqrt(df)."""
    angle = f"atan(abs({t}) / sqrt({df}))"
    power = f"(2.0 * j * ln(greatest(cos({angle}), 1e-300)))"
    even = (f"sin({angle}) * list_sum(list_transform(range(0, cast({df} as bigint) // 2), "
            f"lambda j: exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1.0) + {power})))")
    odd = (f"2 / pi() * ({angle} + case when {df} > 1 then sin({angle}) * cos({angle}) * list_sum(list_transform("
           f"range(0, greatest(cast({df} as bigint) - 1, 2) // 2), lambda j: exp(lgamma(j + 1.0) + lgamma(1.5) - lgamma(j + 1.5) + {power}))) else 0 end)")
    return f"(1 - case when cast({df} as bigint) % 2 = 0 then {even} else {odd} end)"


def t_crit_ctes(dfs: str, name: str = "crit", level: float = 0.95) -> dict[str, str]:
    """CTE (df, t_crit): the quantile by 60 halvings between 0 and 64, for the df of ``dfs``."""
    p = t_p_middle_sql("((lo + hi) / 2)", "df")
    return {f"{name}_steps": f"""select df, 0 as step, 0.0::double as lo, 64.0::double as hi from ({dfs}) where df > 0
            union all select df, step + 1, case when {p} > {1 - level!r} then (lo + hi) / 2 else lo end,
                   case when {p} > {1 - level!r} then hi else (lo + hi) / 2 end
            from {name}_steps where step < 60""",
            name: f"select df, (lo + hi) / 2 as t_crit from {name}_steps where step = 60"}


def f_p_sql(f: str, k: int, d2: str) -> str:
    """P(F > f) for odd k and whole d2: the t tail of sqrt(k f), and one more term of the incomplete
    beta for each two further numerator degrees."""
    x, y = f"({d2} / ({d2} + {k} * {f}))", f"({k} * {f} / ({d2} + {k} * {f}))"
    a = f"({d2} / 2.0)"
    terms = "".join(
        f" + exp({a} * ln({x}) + {b!r} * ln({y}) - ln({b!r}) - lgamma({a}) - lgamma({b!r}) + lgamma({a} + {b!r}))"
        for b in (m + 0.5 for m in range((k - 1) // 2)))
    return f"({t_p_sql(f'sqrt({k} * {f})', d2)}{terms})"


def erfc_sql(x: str) -> str:
    """erfc by its power series up to 1.5, beyond by the continued fraction from its 400th step back."""
    small = (f"(1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 80), lambda n: (case when n % 2 = 0 then 1 else -1 end) "
             f"* exp((2 * n + 1) * ln(greatest({x}, 1e-300)) - lgamma(n + 1.0)) / (2 * n + 1))))")
    large = (f"(exp(-({x}) * ({x})) / sqrt(pi()) / list_reduce(list_prepend(({x})::double, list_transform(range(0, 400), lambda k: (400 - k) / 2.0::double)), "
             f"lambda f, k: ({x}) + k / f))")
    return f"(case when ({x}) < 1.5 then {small} else {large} end)"
