"""Special functions Spark lacks, as small numpy helpers and pandas UDFs over them.

They run on tables that are already aggregated (one row per test, group or parameter), except for
``inside_central_arc``, which is a vectorised test on precomputed window statistics.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(64)


def _integral(f, low, high):
    """Gauss-Legendre integral of f over [low, high] for vectors of ends."""
    half = (high - low) / 2
    t = half[:, None] * (_NODES[None, :] + 1) + low[:, None]
    return half * (f(t) * _WEIGHTS[None, :]).sum(axis=1)


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def normal_quantile(p: float) -> float:
    """Inverse of the normal distribution function by bisection and Newton steps."""
    if p <= 0 or p >= 1:
        return math.copysign(math.inf, p - 0.5)
    low, high = -40.0, 40.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if normal_cdf(mid) < p else (low, mid)
    x = (low + high) / 2
    for _ in range(2):
        density = math.exp(-x * x / 2) / math.sqrt(2 * math.pi)
        if density > 0:
            x -= (normal_cdf(x) - p) / density
    return x


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma: series below a + 1, continued fraction above."""
    if x <= 0:
        return 1.0
    lead = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - total * lead)
    b, c, d = x + 1 - a, 1e300, 1 / (x + 1 - a)
    h = d
    for i in range(1, 500):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b)
        c = b + step / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return lead * h


def beta_lower(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_lower(b, a, 1 - x)
    lead = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    h = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / (1 + step * d)
            c = 1 + step / c
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return lead * h


def chi2_tail(x: float, df: float) -> float:
    return gamma_upper(df / 2, x / 2)


def t_two_sided(t: float, df: float) -> float:
    return beta_lower(df / 2, 0.5, df / (df + t * t))


def f_tail(f: float, d1: float, d2: float) -> float:
    return beta_lower(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def beta_quantile(p: float, a: float, b: float) -> float:
    low, high = 0.0, 1.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if beta_lower(a, b, mid) < p else (low, mid)
    return (low + high) / 2


def digamma(x: float) -> float:
    shift = 0.0
    while x < 8:
        shift -= 1 / x
        x += 1
    y = 1 / (x * x)
    return shift + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def as_udf(function, arguments: int):
    """A pandas UDF of a scalar function of one to three doubles (null or NaN in, null out)."""

    def apply(*series: pd.Series) -> pd.Series:
        rows = zip(*[s.to_numpy(dtype=float) for s in series])
        out = [None if any(math.isnan(v) for v in row) else function(*row) for row in rows]
        return pd.Series(out, dtype="float64")

    def one(a: pd.Series) -> pd.Series:
        return apply(a)

    def two(a: pd.Series, b: pd.Series) -> pd.Series:
        return apply(a, b)

    def three(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return apply(a, b, c)

    return F.pandas_udf({1: one, 2: two, 3: three}[arguments], T.DoubleType())


def kappa_of_resultant(r: np.ndarray) -> np.ndarray:
    """Concentration whose Bessel ratio I1/I0 is the mean resultant length: a start value, then Newton."""
    r = np.clip(r, 0.0, 1 - 1e-12)
    kappa = np.where(
        r < 0.53,
        2 * r + r**3 + 5 * r**5 / 6,
        np.where(r < 0.85, -0.4 + 1.39 * r + 0.43 / (1 - r), 1 / np.maximum(r**3 - 4 * r**2 + 3 * r, 1e-12)),
    )
    zero, whole = np.zeros_like(r), np.full_like(r, math.pi)
    for _ in range(5):
        k = np.clip(kappa, 1e-9, 700.0)
        mass = lambda t: np.exp(k[:, None] * (np.cos(t) - 1))
        ratio = _integral(lambda t: np.cos(t) * mass(t), zero, whole) / _integral(mass, zero, whole)
        slope = np.maximum(1 - ratio / k - ratio**2, 1e-12)
        kappa = np.where(kappa < 700, np.maximum(k - (ratio - r) / slope, 1e-9), kappa)
    return kappa


@F.pandas_udf(T.DoubleType())
def central_mass(resultant: pd.Series, distance: pd.Series) -> pd.Series:
    """Mass of the fitted von Mises law within ``distance`` of its mean direction."""
    r, d = resultant.to_numpy(dtype=float), distance.to_numpy(dtype=float)
    if not len(r):
        return pd.Series([], dtype=float)
    d = np.clip(np.abs((d + math.pi) % (2 * math.pi) - math.pi), 0, math.pi)
    kappa = kappa_of_resultant(r)
    k = np.minimum(kappa, 700.0)
    mass = lambda t: np.exp(k[:, None] * (np.cos(t) - 1))
    zero = np.zeros_like(d)
    exact = _integral(mass, zero, d) / _integral(mass, zero, np.full_like(d, math.pi))
    normal = np.array([math.erf(x) for x in d * np.sqrt(np.minimum(kappa, 1e15) / 2)])
    return pd.Series(np.where(kappa < 700, exact, normal))


# fixed values: coefficients of Wichura's algorithm AS 241 for the normal quantile, highest power first
_CENTRE = (
    (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
     13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608),
    (5226.495278852854561, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
     5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0),
)
_MIDDLE = (
    (7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258,
     3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459,
     0.68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0),
)
_TAIL = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093,
     0.29656057182850489123, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772),
    (2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4,
     0.0148753612908506148525, 0.13692988092273580531, 0.59983220655588793769, 1.0),
)


def with_normal_quantile(df, probability: str, out: str):
    """Add the inverse normal distribution function of a column, in plain column expressions."""

    def ratio(table, x):
        above, below = (F.lit(c[0]) for c in table)
        for a, b in zip(table[0][1:], table[1][1:]):
            above, below = above * x + a, below * x + b
        return above / below

    q = F.col(probability) - 0.5
    r = F.sqrt(-F.log(F.least(F.col(probability), 1 - F.col(probability))))
    # the repeated terms are columns of their own, so that they are computed once
    steps = df.withColumns({"_q": q, "_c": F.lit(0.180625) - q * q, "_m": r - 1.6, "_t": r - 5})
    outer = F.when(F.col("_t") <= 0, ratio(_MIDDLE, F.col("_m"))).otherwise(ratio(_TAIL, F.col("_t")))
    value = F.when(F.abs("_q") <= 0.425, F.col("_q") * ratio(_CENTRE, F.col("_c"))).otherwise(F.signum("_q") * outer)
    return steps.withColumn(out, value).drop("_q", "_c", "_m", "_t")
