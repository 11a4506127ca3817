"""Tails of t, F and chi-square as SQL expressions: no Python stage, and relative accuracy however thin the tail.

The regularised incomplete beta is the continued fraction of DLMF 8.17.22, run by the modified Lentz method as an
``aggregate`` over a sequence of steps whose length follows from the parameters (their root, near the mean). Every function
takes and returns SQL text, to be used with ``F.expr``; text keeps such large expressions cheap to build. ``_let`` binds
names to values, so that each is written and computed once.
"""

from __future__ import annotations

import itertools
import math
from statistics import NormalDist

#: Steps of the continued fraction: a fixed part, and a multiple of the root of the larger parameter.
STEPS, STEPS_PER_ROOT, MOST_STEPS = 40, 4.0, 200_000
#: Steps of Newton's method for a quantile; of the series and the continued fraction of erfc.
NEWTON, SERIES, FRACTION = 12, 60, 120
_SHIFT = 10
_names = itertools.count()


def _num(x: float) -> str:
    return f"{float(x)!r}D"


def _let(body: str, **values: str) -> str:
    """``body`` with each $name in it standing for the value of that name."""
    v = f"v{next(_names)}"
    for name in sorted(values, key=len, reverse=True):
        body = body.replace(f"${name}", f"{v}.{name}")
    fields = ", ".join(f"'{name}', {value}" for name, value in values.items())
    return f"transform(array(named_struct({fields})), {v} -> {body})[0]"


def _stirling(z: str) -> str:
    """log gamma(z) minus its leading terms, for z of ten and more."""
    return _let("(1D/12D - $w * (1D/360D - $w * (1D/1260D - $w * (1D/1680D - $w / 1188D)))) / $z", w=f"1D / (({z}) * ({z}))", z=z)


def _lgamma(z: str) -> str:
    product = " * ".join(f"($z + {i}D)" for i in range(_SHIFT))
    inner = f"($far - 0.5D) * ln($far) - $far + {_num(0.5 * math.log(2 * math.pi))} + {_stirling('$far')} - ln($product)"
    return _let(_let(inner, far=f"($z + {_SHIFT}D)", product=product), z=z)


def _log_beta(a: str, b: str) -> str:
    """log B(a, b), also where one argument is so large that log gammas would cancel."""
    far = (f"{_lgamma('$small')} - ($small * ln($large + $small) + ($large - 0.5D) * log1p($small / $large) - $small + "
           f"{_stirling('($large + $small)')} - {_stirling('$large')})")
    near = f"{_lgamma('$small')} + {_lgamma('$large')} - {_lgamma('($small + $large)')}"
    return _let(f"case when $large >= 50D then {far} else {near} end", small=f"least({a}, {b})", large=f"greatest({a}, {b})")


def _nonzero(x: str) -> str:
    return _let("case when abs($x) < 1e-300D then 1e-300D else $x end", x=x)


def _fraction(a: str, b: str, x: str) -> str:
    """Continued fraction for I_x(a, b), for x < (a + 1) / (a + b + 2)."""
    s, m = f"s{next(_names)}", f"m{next(_names)}"

    def half(state: str, term: str) -> str:
        step = _let("named_struct('c', $c, 'd', $d, 'h', $h * $c * $d)", c=_nonzero("1D + $t / $s.c"), d=f"1D / {_nonzero('1D + $t * $s.d')}", h="$s.h")
        return _let(step, t=term, s=state)

    even = f"({m} * ({b} - {m}) * {x} / (({a} - 1D + 2D * {m}) * ({a} + 2D * {m})))"
    odd = f"(-({a} + {m}) * ({a} + {b} + {m}) * {x} / (({a} + 2D * {m}) * ({a} + 1D + 2D * {m})))"
    start = _let("named_struct('c', 1D, 'd', $d, 'h', $d)", d=f"1D / {_nonzero(f'1D - ({a} + {b}) * {x} / ({a} + 1D)')}")
    n = f"least({MOST_STEPS}, cast({STEPS} + {STEPS_PER_ROOT!r}D * sqrt(greatest({a}, {b})) as int))"
    steps = f"transform(sequence(1, {n}), i -> cast(i as double))"
    return f"aggregate({steps}, {start}, ({s}, {m}) -> {half(half(s, even), odd)}, {s} -> {s}.h)"


def betainc(a: str, b: str, x: str, y: str) -> str:
    """Regularised incomplete beta I_x(a, b) with y = 1 - x, both given so that neither loses digits. NULL where an
    argument is NULL or a parameter not above zero."""
    log = lambda p, q: f"(case when {q} < 0.5D then log1p(-{q}) else ln({p}) end)"
    front = f"exp($a * {log('$x', '$y')} + $b * {log('$y', '$x')} - {_log_beta('$a', '$b')})"
    turned = _let(f"$front * {_fraction('$a', '$b', '$x')} / $a", front=front, a="case when $direct then $a else $b end",
                  b="case when $direct then $b else $a end", x="case when $direct then $x else $y end")
    inner = _let("case when $direct then $r else 1D - $r end", r=turned, direct="$direct")
    inner = _let(inner, a="$a", b="$b", x="$x", y="$y", direct="$x < ($a + 1D) / ($a + $b + 2D)")
    whole = f"case when $a > 0D and $b > 0D then case when $x <= 0D then 0D when $y <= 0D then 1D else {inner} end end"
    return _let(whole, a=f"cast({a} as double)", b=f"cast({b} as double)", x=f"cast({x} as double)", y=f"cast({y} as double)")


def t_two_sided_p(t: str, df: str) -> str:
    """P(|T| > |t|) for Student's t with ``df`` degrees of freedom; NULL without any."""
    inner = betainc("$df / 2D", "0.5D", "$df / ($df + $t * $t)", "$t * $t / ($df + $t * $t)")
    whole = f"case when $df > 0D and not isnan($t) then case when abs($t) = double('Infinity') then 0D else {inner} end end"
    return _let(whole, t=f"cast({t} as double)", df=f"cast({df} as double)")


def t_critical(level: float, df: str) -> str:
    """The t with P(|T| > t) = 1 - level: Newton's method on the logarithm of the tail, from a start by the normal quantile."""
    z, alpha = NormalDist().inv_cdf(0.5 + level / 2.0), 1.0 - level
    t, i = f"t{next(_names)}", f"i{next(_names)}"
    step = _let(f"{t} + (ln($p) - {_num(math.log(alpha))}) * $p / (2D * exp($f))", p=t_two_sided_p(t, "$df"),
                f=f"-($df + 1D) / 2D * log1p({t} * {t} / $df) - $norm")
    newton = f"aggregate(sequence(1, {NEWTON}), {_num(z)} + {_num((z ** 3 + z) / 4)} / $df, ({t}, {i}) -> {step})"
    whole = _let(newton, df="$df", norm=f"{_log_beta('$df / 2D', '0.5D')} + 0.5D * ln($df)")
    return _let(f"case when $df > 0D then {whole} end", df=f"cast({df} as double)")


def f_upper_p(f: str, d1: str, d2: str) -> str:
    """P(F > f) with (d1, d2) degrees of freedom."""
    inner = betainc("$dd / 2D", "$dn / 2D", "$dd / ($dd + $dn * $f)", "$dn * $f / ($dd + $dn * $f)")
    whole = f"case when $dn > 0D and $dd > 0D and $f >= 0D then case when $f = double('Infinity') then 0D else {inner} end end"
    return _let(whole, f=f"cast({f} as double)", dn=f"cast({d1} as double)", dd=f"cast({d2} as double)")


def erfc(x: str) -> str:
    """Complementary error function of x >= 0: its power series up to 1.5, beyond by the continued fraction from the last step back."""
    s, k = f"s{next(_names)}", f"k{next(_names)}"
    add = _let(f"named_struct('t', $t, 's', {s}.s + $t / (2D * {k} + 1D))", t=f"-{s}.t * $x * $x / {k}")
    series = (f"1D - {_num(2 / math.sqrt(math.pi))} * aggregate(sequence(1, {SERIES}), named_struct('t', $x, 's', $x), ({s}, {k}) -> {add}, {s} -> {s}.s)")
    back = f"aggregate(sequence({FRACTION}, 1), $x, ({s}, {k}) -> $x + {k} / 2D / {s})"
    fraction = f"exp(-$x * $x) * {_num(1 / math.sqrt(math.pi))} / {back}"
    return _let(f"case when $x >= 0D then case when $x < 1.5D then {series} else {fraction} end end", x=f"cast({x} as double)")


def chi2_1df_upper_p(x: str) -> str:
    """P(X > x) for chi-square with one degree of freedom."""
    return erfc(f"sqrt({x} / 2D)")
