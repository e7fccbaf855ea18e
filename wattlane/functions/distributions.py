"""Distribution functions as native column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hart's rational approximation of the normal tail, numerator and denominator by falling power.
HART_ABOVE = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
              221.213596169931, 220.206867912376]
HART_BELOW = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
              637.333633378831, 793.826512519948, 440.413735824752]
#: Steps of the continued fraction: it needs about the root of the larger parameter.
STEPS = 2_000


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + c
    return out


def normal_cdf(z: Column) -> Column:
    """P(Z <= z) of the standard normal, to about 1e-14; null and NaN stay what they are."""
    x = F.abs(z)
    density = F.exp(-x * x / 2)
    near = density * _polynomial(x, HART_ABOVE) / _polynomial(x, HART_BELOW)
    far = density / (x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 0.65))))) / math.sqrt(2 * math.pi)
    tail = F.when(F.isnan(z), z).when(x > 37, 0.0).when(x < 7.07, near).otherwise(far)
    return F.when(z > 0, 1 - tail).otherwise(tail)


def kolmogorov_tail(statistic: Column, n: Column) -> Column:
    """Limiting probability of a Kolmogorov-Smirnov distance beyond ``statistic`` over ``n`` values."""
    x = F.least(n * statistic * statistic, F.lit(1e4))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(200)), F.lit(0.0),
                         lambda acc, j: acc + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * x))
    # Below this the alternating series no longer converges, and the tail is 1 to every digit.
    return F.when(x < 0.04, 1.0).otherwise(F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0)))


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0, by Stirling's series ten steps up."""
    y = x + 10
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5.0))) - 1 / (1680 * F.pow(y, F.lit(7.0)))
    up = F.log(x)
    for k in range(1, 10):
        up = up + F.log(x + k)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - up


def incomplete_beta(x: Column, a: Column, b: Column) -> Column:
    """The regularised incomplete beta function of x in [0, 1], a > 0, b > 0, by its continued fraction."""
    swap = x > (a + 1) / (a + b + 2)
    p = F.struct(F.when(swap, 1 - x).otherwise(x).alias("x"), F.when(swap, b).otherwise(a).alias("a"),
                 F.when(swap, a).otherwise(b).alias("b"))
    tiny = 1e-300

    def safe(v: Column) -> Column:
        return F.when(F.abs(v) < tiny, tiny).otherwise(v)

    def turn(s: Column, q: Column, term: Column) -> Column:
        d = 1 / safe(1 + term * s["d"])
        c = safe(1 + term / s["c"])
        return F.struct(q.alias("q"), c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    def even(s: Column, m: Column) -> Column:
        q = s["q"]
        return turn(s, q, m * (q["b"] - m) * q["x"] / ((q["a"] + 2 * m - 1) * (q["a"] + 2 * m)))

    def odd(s: Column, m: Column) -> Column:
        q = s["q"]
        return turn(s, q, -(q["a"] + m) * (q["a"] + q["b"] + m) * q["x"] / ((q["a"] + 2 * m) * (q["a"] + 2 * m + 1)))

    # Half steps: even ones 2m and odd ones 2m + 1.
    d = 1 / safe(1 - (p["a"] + p["b"]) * p["x"] / (p["a"] + 1))
    start = F.struct(p.alias("q"), F.lit(1.0).alias("c"), d.alias("d"), d.alias("h"))
    half = F.aggregate(F.sequence(F.lit(2), F.lit(2 * STEPS + 1)), start, lambda s, i: F.when(
        i % 2 == 0, even(s, F.floor(i / 2))).otherwise(odd(s, F.floor(i / 2))))
    scale = F.exp(p["a"] * F.log(p["x"]) + p["b"] * F.log1p(-p["x"]) + log_gamma(a + b) - log_gamma(a) - log_gamma(b))
    value = scale * half["h"] / p["a"]
    inside = F.when(swap, 1 - value).otherwise(value)
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(inside)


def f_tail(f: Column, between: Column, within: Column) -> Column:
    """P(F > f) with ``between`` and ``within`` degrees of freedom."""
    return F.when(f <= 0, 1.0).otherwise(incomplete_beta(within / (within + between * f), within / 2.0, between / 2.0))
