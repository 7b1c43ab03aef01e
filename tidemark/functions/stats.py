"""Tail probabilities as column arithmetic (no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark._util import col_of

#: Coefficients of the asymptotic series of log gamma, from 1/z on, in odd powers.
_LOG_GAMMA = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
_SHIFT = 10
_HALF_LOG_2PI = 0.9189385332046727
_TINY = 1e-300


def let(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once: an expression that names it often does not grow."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def log_gamma(z) -> Column:
    """Log of the gamma function for z > 0: asymptotic series at z + 10, less the logs of the steps up."""

    def at(x: Column) -> Column:
        far = x + F.lit(float(_SHIFT))
        steps = x
        for k in range(1, _SHIFT):
            steps = steps * (x + F.lit(float(k)))
        series = F.lit(0.0)
        for k, c in enumerate(_LOG_GAMMA):
            series = series + F.lit(c) / F.pow(far, F.lit(2.0 * k + 1))
        return (far - 0.5) * F.log(far) - far + F.lit(_HALF_LOG_2PI) + series - F.log(steps)

    return let(col_of(z).cast("double"), at)


def _not_zero(x: Column) -> Column:
    return F.when(F.abs(x) < _TINY, F.lit(_TINY)).otherwise(x)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, evaluated forwards (two quotients a step).

    A fixed number of steps that grows with the square root of the larger
    parameter, as its convergence does."""
    steps = F.least(F.lit(100_000), F.lit(60) + F.ceil(F.sqrt(F.greatest(a, b)) * 4)).cast("int")

    def step(s: Column, m: Column) -> Column:
        m = m.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))

        def turn(q: Column, s: Column) -> Column:
            d = F.lit(1.0) / _not_zero(1 + q * s["d"])
            c = _not_zero(1 + q / s["c"])
            return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

        return let(turn(even, s), lambda t: turn(odd, t))

    first = F.lit(1.0) / _not_zero(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    return F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda s: s["h"])


def incomplete_beta(a, b, x, rest=None) -> Column:
    """Regularised incomplete beta function I_x(a, b); ``rest`` is 1 - x where that is known more exactly."""
    a, b, x = (col_of(c).cast("double") for c in (a, b, x))
    rest = 1 - x if rest is None else col_of(rest).cast("double")

    def of(v: Column) -> Column:
        a, b, x, y = (v[n] for n in "abxy")
        front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(y))
        below = x < (a + 1) / (a + b + 2)
        inner = F.when(below, front * _fraction(a, b, x) / a).otherwise(1 - front * _fraction(b, a, y) / b)
        return F.when(x <= 0, 0.0).when(y <= 0, 1.0).otherwise(inner)

    return let(F.struct(a.alias("a"), b.alias("b"), x.alias("x"), rest.alias("y")), of)


def f_tail(f, df1, df2) -> Column:
    """P(F > f) of the F distribution with (df1, df2) degrees of freedom; NULL if f is NULL or a df is not positive."""
    f, d1, d2 = (col_of(c).cast("double") for c in (f, df1, df2))
    total = d2 + d1 * f
    p = F.when(f <= 0, F.lit(1.0)).when(f == F.lit(float("inf")), F.lit(0.0)).otherwise(incomplete_beta(d2 / 2, d1 / 2, F.try_divide(d2, total), F.try_divide(d1 * f, total)))
    return F.when((d1 > 0) & (d2 > 0) & f.isNotNull(), p)
