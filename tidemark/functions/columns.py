"""Scalar column functions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_uniform(seed, *parts) -> Column:
    """Reproducible draw in [0, 1) from ``md5(seed:part1:part2...)``.

    Replaces a random-number stream: the value depends only on the seed and
    the row key, so it is identical on every executor, after any retry, and in
    any engine that has md5 (the DuckDB oracle uses the same formula).
    """
    items = [F.lit(str(seed))] + [F.lit(p) if isinstance(p, (int, float)) else _c(p) for p in parts]
    hexed = F.substring(F.md5(F.concat_ws(":", *[i.cast("string") for i in items])), 1, 8)
    return F.conv(hexed, 16, 10).cast("long") / F.lit(TWO_POW_32)


def lenient_double(c) -> Column:
    """Bad, blank or NaN numbers become 0.0 (``to_numeric(errors='coerce').fillna(0)``).

    Java's number suffixes (``1d``, ``1f``) and hexadecimal forms are bad numbers too.
    """
    text = f"trim(cast({_sql(c)} as string))"
    value = F.nanvl(F.expr(f"try_cast({text} as double)"), F.lit(0.0))
    return F.when(F.expr(f"{text} rlike '(?i)^[+-]?0x|[0-9.][df]$'"), F.lit(0.0)).otherwise(F.coalesce(value, F.lit(0.0)))


def _sql(c) -> str:
    if isinstance(c, str):
        return "`" + c.replace("`", "``") + "`"
    raise TypeError("column name expected")


def to_int(c) -> Column:
    """Integer cast truncating toward zero."""
    return _c(c).cast("int")


def smoothed_ratio(num, den) -> Column:
    """``num / (den + 1)`` on doubles (AvgMonthlyCharge-style ratio)."""
    return _c(num).cast("double") / (_c(den).cast("double") + F.lit(1.0))


def count_equal(cols: Iterable, value) -> Column:
    """Number of columns equal to ``value``; a null cell counts as 0."""
    terms = [F.when(_c(c) == F.lit(value), 1).otherwise(0) for c in cols]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def dict_map(c, mapping: Mapping, otherwise=None) -> Column:
    """Dictionary map; unmapped values become null (``Series.map(dict)``)."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(_c(c) == F.lit(k), F.lit(v)) if expr is None else expr.when(_c(c) == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(otherwise))


def clip(c, lower=None, upper=None) -> Column:
    """Clip to [lower, upper]; null stays null (``greatest`` alone would skip it)."""
    out = _c(c)
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(_c(c).isNotNull(), out)


def round_score(c, digits: int = 6) -> Column:
    """Served score rounding (half-even on the decimal text)."""
    return F.bround(_c(c), digits)


def decide(c, threshold: float = 0.5) -> Column:
    """Hard decision ``score >= threshold`` as 0/1 int."""
    return (_c(c) >= F.lit(threshold)).cast("int")


def status_band(c, t1: float, t2: float, labels=("red", "yellow", "green"),
                higher_is_better: bool = True) -> Column:
    """Threshold bands: below t1, between, at or above t2."""
    lo, mid, hi = labels
    if higher_is_better:
        return (F.when(_c(c).isNull(), F.lit(None))
                .when(_c(c) >= t2, F.lit(hi)).when(_c(c) >= t1, F.lit(mid)).otherwise(F.lit(lo)))
    return (F.when(_c(c).isNull(), F.lit(None))
            .when(_c(c) >= t2, F.lit(lo)).when(_c(c) >= t1, F.lit(mid)).otherwise(F.lit(hi)))


def safe_ratio(num, den, default=0.0) -> Column:
    """``num/den`` or ``default`` when the denominator is 0 (ANSI-safe)."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(default))


def gaussian_from_uniforms(u1, u2) -> Column:
    """Standard normal draw from two uniforms (Box–Muller)."""
    u1c = F.greatest(_c(u1), F.lit(1e-12))
    return F.sqrt(F.lit(-2.0) * F.log(u1c)) * F.cos(F.lit(6.283185307179586) * _c(u2))
