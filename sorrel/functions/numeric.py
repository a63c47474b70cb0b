"""Numeric functions as SQL text (the same text runs in Spark and in other SQL engines) and, where no expression will do, for driver and kernels."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Coefficients of AS 241 (Wichura 1988), highest power first: centre, middle and tail, numerator and denominator.
AS241 = (
    (
        (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457, 13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608),
        (5226.495278852854561, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867, 5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0),
    ),
    (
        (7.7454501427834140764e-4, 2.27238449892691845833e-2, 2.4178072517745061177e-1, 1.27045825245236838258, 3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734),
        (1.05075007164441684324e-9, 5.475938084995344946e-4, 1.51986665636164571966e-2, 1.4810397642748007459e-1, 6.8976733498510000455e-1, 1.6763848301838038494, 2.05319162663775882187, 1.0),
    ),
    (
        (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.2426609473880784386e-3, 2.6532189526576123093e-2, 2.9656057182850489123e-1, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772),
        (2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4, 1.48753612908506148525e-2, 1.3692988092273580531e-1, 5.9983220655588793769e-1, 1.0),
    ),
)
#: Median of the chi-square distribution with one degree of freedom.
CHI2_MEDIAN_1 = 0.454936423119572


def number(x: float) -> str:
    """A double literal that every SQL dialect reads as a double."""
    return f"CAST('{x!r}' AS DOUBLE)"


def _horner(coefficients: tuple[float, ...], r: str) -> str:
    out = number(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {r} + {number(c)})"
    return out


def upper_normal_quantile_sql(p: str) -> str:
    """SQL for the |quantile| of the standard normal at tail probability p, 0 < p <= 1/2."""
    (cn, cd), (mn, md), (tn, td) = AS241
    q = f"({number(0.5)} - ({p}))"
    r = f"({number(0.180625)} - {q} * {q})"
    s = f"sqrt(-ln({p}))"
    m, t = f"({s} - {number(1.6)})", f"({s} - {number(5.0)})"
    return f"CASE WHEN {q} <= {number(0.425)} THEN {q} * {_horner(cn, r)} / {_horner(cd, r)} WHEN {s} <= {number(5.0)} THEN {_horner(mn, m)} / {_horner(md, m)} ELSE {_horner(tn, t)} / {_horner(td, t)} END"


def chi2_isf_1_sql(p: str) -> str:
    """SQL for the upper quantile of chi-square with one degree of freedom. A p whose half isn't above 0 counts as the smallest normal double."""
    z = upper_normal_quantile_sql(f"greatest(({p}) / {number(2.0)}, {number(2.2250738585072014e-308)})")
    return f"power({z}, {number(2.0)})"


def chi2_isf_1(p: str) -> Column:
    return F.expr(chi2_isf_1_sql(p))


#: Terms of the series of the normal distribution below 3, and levels of the continued fraction of its tail above.
_TERMS, _LEVELS = 60, 90
#: Newton steps for a quantile, from a start that is near.
STEPS = 14


def _double_factorial(n: int) -> float:
    return float(math.prod(range(n, 0, -2)))


def upper_normal_sql(z: str) -> str:
    """SQL for the tail probability of the standard normal above z >= 0: a series below 3, a continued fraction above. Only z is repeated, so the text grows with its terms."""
    series = number(1.0)
    for k in range(_TERMS, 0, -1):
        series = f"({number(1.0)} + {z} * {z} / {number(2.0 * k + 1)} * {series})"
    tail = z
    for k in range(_LEVELS, 0, -1):
        tail = f"({z} + {number(float(k))} / {tail})"
    density = f"(exp(-{z} * {z} / {number(2.0)}) * {number(1 / math.sqrt(2 * math.pi))})"
    return f"CASE WHEN {z} < {number(3.0)} THEN {number(0.5)} - {density} * {z} * {series} ELSE {density} / {tail} END"


def chi2_sf_sql(z: str, df: int) -> tuple[str, str]:
    """SQL for the upper tail of chi-square at z * z and for minus its derivative by z, both times exp(z * z / 2): finite sums for whole degrees of freedom, and the normal tail for odd ones."""
    m, odd = divmod(df, 2)
    if odd:
        total = number(0.0)
        for j in range(m, 0, -1):
            total = f"({total} * {z} * {z} + {number(1 / _double_factorial(2 * j - 1))})"
        c = number(math.sqrt(2 / math.pi))
        # the tail times exp(z * z / 2) without a product of the very small and the very large
        tail = z
        for k in range(_LEVELS, 0, -1):
            tail = f"({z} + {number(float(k))} / {tail})"
        scaled = f"CASE WHEN {z} < {number(3.0)} THEN {number(2.0)} * ({upper_normal_sql(z)}) * exp({z} * {z} / {number(2.0)}) ELSE {c} / {tail} END"
        return f"({scaled}) + {c} * {z} * {total}", f"{c} * power({z}, {number(2.0 * m)}) / {number(_double_factorial(2 * m - 1))}"
    total = number(0.0)
    for j in range(m - 1, -1, -1):
        total = f"({total} * {z} * {z} / {number(2.0)} + {number(1 / math.factorial(j))})"
    return total, f"{z} * power({z} * {z} / {number(2.0)}, {number(m - 1.0)}) / {number(float(math.factorial(m - 1)))}"


def _chi2_steps(p: str, df: int) -> tuple[str, str]:
    """SQL of where Newton's method starts, and of its next value after z: both for the square root of the upper quantile of chi-square with `df` degrees of freedom at p, 0 < p <= 1.

    The method finds the zero of the logarithm of the tail by z. It starts from the cube-root approximation by normal quantiles, or, for p above 0.9, from the leading power of the lower tail. The logarithm of the tail is concave, so
    steps from above never overshoot.
    """
    if isinstance(df, bool) or not isinstance(df, int) or df < 1:
        raise ValueError(f"degrees of freedom must be a positive whole number, not {df!r}")
    n = float(df)
    half = f"greatest(least({p}, {number(1.0)} - {p}), {number(2.2250738585072014e-308)})"
    normal = f"(CASE WHEN {p} > {number(0.5)} THEN -1 ELSE 1 END * ({upper_normal_quantile_sql(half)}))"
    cube = f"({number(1 - 2 / (9 * n))} + {normal} * {number(math.sqrt(2 / (9 * n)))})"
    low = f"({number(2.0)} * power(({number(1.0)} - {p}) * {number(math.gamma(n / 2 + 1))}, {number(2 / n)}))"
    tail, slope = chi2_sf_sql("z", df)
    step = f"z + (ln({tail}) - z * z / {number(2.0)} - ln({p})) * ({tail}) / ({slope})"
    return f"sqrt(CASE WHEN {p} > {number(0.9)} THEN {low} ELSE {number(n)} * power(greatest({cube}, {number(1e-3)}), {number(3.0)}) END)", f"greatest(least({step}, {number(2.0)} * z + {number(1.0)}), z / {number(4.0)})"


def chi2_isf(p: str, df: int) -> Column:
    """The upper quantile of chi-square with `df` degrees of freedom: a fixed number of Newton steps as one fold."""
    start, step = _chi2_steps(p, df)
    return F.expr(f"CASE WHEN {p} >= {number(1.0)} THEN {number(0.0)} ELSE power(aggregate(sequence(1, {STEPS}), {start}, (z, i) -> {step}), {number(2.0)}) END")


def chi2_isf_sql(relation: str, p: str, df: int, name: str = "chi2") -> str:
    """The same as SQL of the relation's rows with the quantile as column `name`, for engines without such a fold: each step is a subquery, so that nothing is repeated."""
    start, step = _chi2_steps(p, df)
    sql = f"SELECT *, {start} AS z FROM {relation}"
    for _ in range(STEPS):
        sql = f"SELECT * EXCLUDE (z), CASE WHEN {p} >= {number(1.0)} THEN {number(1.0)} ELSE {step} END AS z FROM ({sql}) AS s"
    return f"SELECT * EXCLUDE (z), CASE WHEN {p} >= {number(1.0)} THEN {number(0.0)} ELSE z * z END AS {name} FROM ({sql}) AS s"


def chi2_median(df: int) -> float:
    """The median, by bisection on the driver."""
    m, odd = divmod(df, 2)

    def tail(x: float) -> float:
        h = x / 2
        if odd:
            return math.erfc(math.sqrt(h)) + sum(math.exp(-h + (j - 0.5) * math.log(h) - math.lgamma(j + 0.5)) for j in range(1, m + 1))
        return sum(math.exp(-h + j * math.log(h) - math.lgamma(j + 1)) for j in range(m))

    low, high = 1e-9, 2.0 * df + 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if tail(middle) > 0.5 else (low, middle)
    return (low + high) / 2


def neg_log10_decimal(text: str) -> Column:
    """-log10 of a decimal number given as text, which may be far below the double range: mantissa and exponent are taken apart. Null if malformed or not in (0, 1]."""
    pattern = r"^\+?(\d+\.?\d*|\.\d+)(?:[eE]([+-]?\d+))?$"
    whole, power = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
    mantissa = F.expr(f"try_cast({'regexp_extract(' + text + ', r' + chr(39) + pattern + chr(39) + ', 1)'} as double)")
    exponent = F.when(power == "", F.lit(0.0)).otherwise(power.try_cast("double"))
    out = -(F.log10(mantissa) + exponent)
    return F.when((whole != "") & (mantissa > 0) & (out >= -1e-12), F.greatest(out, F.lit(0.0)))


def log_t_sf(t, df: float):
    """Natural log of P(T > |t|), Student's t, for a number or an array of them: the continued fraction of the incomplete beta function in log space, so far tails don't vanish."""
    scalar, t = np.ndim(t) == 0, np.atleast_1d(np.abs(np.asarray(t, float)))
    a, b, out = df / 2.0, 0.5, np.full(t.shape, np.nan)
    out[np.isinf(t)] = -np.inf
    known = np.isfinite(t)
    s = t[known]
    # x = df / (df + t^2) and 1 - x by logarithms, as either may be far below the other
    ratio = 2 * np.log(np.maximum(s, 1e-300)) - math.log(df)
    log_x, log_y = -np.logaddexp(0.0, ratio), -np.logaddexp(0.0, -ratio)
    front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * log_x + b * log_y
    x, y = np.exp(log_x), np.exp(log_y)
    far = x < (a + 1) / (a + b + 2)
    value = np.empty(len(s))
    value[far] = front[far] + np.log(_beta_fraction(a, b, x[far]) / a) - math.log(2)
    near = np.minimum(np.exp(front[~far]) * _beta_fraction(b, a, y[~far]) / b, 1.0)
    with np.errstate(divide="ignore"):
        value[~far] = np.log1p(-near) - math.log(2)
    value[s == 0] = -math.log(2)
    out[known] = value
    return float(out[0]) if scalar else out


def _beta_fraction(a: float, b: float, x: np.ndarray) -> np.ndarray:
    """Modified Lentz evaluation of all elements at once, until the last one stands still."""
    tiny = 1e-300

    def off_zero(v: np.ndarray) -> np.ndarray:
        return np.where(np.abs(v) > tiny, v, tiny)

    c, d = np.ones_like(x), 1 / off_zero(1.0 - (a + b) * x / (a + 1))
    h = d.copy()
    for m in range(1, 2000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 / off_zero(1 + term * d), off_zero(1 + term / c)
            h = h * d * c
        if not len(x) or np.abs(d * c - 1).max() < 1e-15:
            break
    return h


def bounded_minimum(f, low: float, high: float, tolerance: float = 1e-8) -> float:
    """Golden-section search."""
    g = (math.sqrt(5) - 1) / 2
    a, b = low, high
    c, d = b - g * (b - a), a + g * (b - a)
    fc, fd = f(c), f(d)
    while b - a > tolerance:
        if fc <= fd:
            b, d, fd = d, c, fc
            c = b - g * (b - a)
            fc = f(c)
        else:
            a, c, fc = c, d, fd
            d = a + g * (b - a)
            fd = f(d)
    return (a + b) / 2
