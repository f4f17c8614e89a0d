"""p-values of drift statistics as column expressions.

Finite sums and short recurrences over ``sequence`` arrays, so they run in the
JVM with the rows they belong to: the chi-square tail for whole degrees of
freedom (a Poisson sum for even ones; the complementary error function and a
half-integer sum for odd ones, terms in logarithms), and the asymptotic
Kolmogorov distribution.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAN = float("nan")


def _c(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def erfc(z) -> Column:
    """Complementary error function of ``z >= 0``: series below 3, continued fraction above."""
    z = _c(z)
    square = F.exp(-z * z)
    # erf(z) = 2 / sqrt(pi) exp(-z^2) sum z (2 z^2)^n / (1 * 3 * ... * (2 n + 1))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(80)), F.struct(z.alias("term"), z.alias("sum")), lambda a, n: F.struct(
        (a["term"] * 2 * z * z / (2 * n + 1)).alias("term"), (a["sum"] + a["term"] * 2 * z * z / (2 * n + 1)).alias("sum")))["sum"]
    fraction = F.aggregate(F.sequence(F.lit(80), F.lit(1)), z, lambda f, n: z + n / 2 / f)
    return F.when(z < 3, 1 - 2 / math.sqrt(math.pi) * square * series).otherwise(square / math.sqrt(math.pi) / fraction)


def chi2_pvalue(stat, dof) -> Column:
    """P(X >= stat) for X ~ chi-square(dof), dof a whole number; null, NaN or infinite statistics and dof <= 0 give NaN."""
    y, k = _c(stat) / 2, F.floor(_c(dof))
    even = k % 2 == 0
    n = F.floor(k / 2).cast("int")  # terms of the sum: i = 0 .. n - 1, or i = 1/2, 3/2, .. (n of them)
    first = F.when(even, -y).otherwise(F.log(y) / 2 - y - math.log(math.sqrt(math.pi) / 2))
    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.struct(first.alias("log"), F.lit(0.0).alias("sum")), lambda a, i: F.struct(
        (a["log"] + F.log(y) - F.log(F.when(even, i.cast("double")).otherwise(i + 0.5))).alias("log"), (a["sum"] + F.exp(a["log"])).alias("sum")))["sum"]
    tail = F.when(n > 0, total).otherwise(0.0) + F.when(even, 0.0).otherwise(erfc(F.sqrt(y)))
    p = F.when(y > 0, F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0))).otherwise(1.0)
    usable = y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")) & k.isNotNull() & (k > 0)
    return F.when(usable, p).otherwise(F.lit(_NAN))


def ks_pvalue(d, n, m) -> Column:
    """Asymptotic two-sample KS p-value with the effective sample size."""
    d, n, m = _c(d), _c(n), _c(m)
    size = F.sqrt(n * m / (n + m))
    lam = (size + 0.12 + 0.11 / size) * d
    total = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda a, k: a + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam))
    # below 0.1 the distribution is 1 to far more digits than a double has
    return F.when(lam < 0.1, F.lit(1.0)).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))
