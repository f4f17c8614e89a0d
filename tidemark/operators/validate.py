"""Record validation as a table job: valid rows and a quarantine with reasons.

Rules are declarative; each becomes one boolean column expression, all
evaluated in one projection.  ``quarantine`` rows carry
``errors`` = ``field:rule`` strings joined by ``;`` and ``n_errors``.
Warnings (cross-field rules, off by default) are reported but do not
quarantine.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> Column:
    return F.col("`" + name + "`")


@dataclass(frozen=True)
class Rule:
    field: str
    rule: str
    ok: Column             # true when the value passes (null-safe)
    warning: bool = False


def enum_rule(field: str, values: Sequence[str]) -> Rule:
    """Case-sensitive membership; a null is left to the required rule."""
    return Rule(field, "enum", _q(field).isNull() | _q(field).isin(list(values)))


def literal_rule(field: str, values: Sequence) -> Rule:
    return Rule(field, "literal", _q(field).isNull() | _q(field).isin(list(values)))


def range_rule(field: str, ge=None, le=None) -> Rule:
    c = F.expr(f"try_cast(`{field}` as double)")
    ok = F.lit(True)
    if ge is not None:
        ok = ok & (c >= F.lit(ge))
    if le is not None:
        ok = ok & (c <= F.lit(le))
    return Rule(field, "range", c.isNull() | (~F.isnan(c) & ok))  # NaN is in no range


def required_rule(field: str, type_name: str | None = None) -> Rule:
    """Present, non-null (NaN counts as missing) and castable to ``type_name``."""
    ok = _q(field).isNotNull()
    if type_name:
        value = F.expr(f"try_cast(`{field}` as {type_name})")
        ok = ok & value.isNotNull()
        if type_name in ("double", "float"):
            ok = ok & ~F.coalesce(F.isnan(value), F.lit(False))
    return Rule(field, "required", ok)


def implies_rule(field: str, condition: Column, then: Column, name: str = "cross") -> Rule:
    """Cross-field implication ``condition => then``; a warning by default."""
    return Rule(field, name, ~F.coalesce(condition, F.lit(False)) | F.coalesce(then, F.lit(False)),
                warning=True)


def check(df: DataFrame, rules: Sequence[Rule], with_warnings: bool = False) -> DataFrame:
    """Input plus ``errors`` (string, '' when valid), ``n_errors``, ``warnings``."""
    errs = [F.when(~r.ok, F.lit(f"{r.field}:{r.rule}")) for r in rules if not r.warning or with_warnings]
    warns = [F.when(~r.ok, F.lit(f"{r.field}:{r.rule}")) for r in rules if r.warning and not with_warnings]
    arr = F.filter(F.array(*errs), lambda x: x.isNotNull()) if errs else F.array().cast("array<string>")
    warr = F.filter(F.array(*warns), lambda x: x.isNotNull()) if warns else F.array().cast("array<string>")
    return (df.withColumn("_err", arr)
              .withColumn("errors", F.array_join("_err", ";"))
              .withColumn("n_errors", F.size("_err"))
              .withColumn("warnings", F.array_join(warr, ";"))
              .drop("_err"))


def split_valid(df: DataFrame, rules: Sequence[Rule]):
    """(valid, quarantine) from one checked frame."""
    c = check(df, rules)
    return (c.filter(F.col("n_errors") == 0).drop("errors", "n_errors"),
            c.filter(F.col("n_errors") > 0))


def require_nonempty(df: DataFrame) -> DataFrame:
    """An empty batch is an error (checked with a one-row probe, not a count)."""
    if df.isEmpty():
        raise ValueError("empty batch")
    return df


# Record schema of the churn records (the customer-record analogue).
MART_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def mart_rules(with_cross: bool = False) -> list[Rule]:
    rules = [enum_rule("c_mktsegment", MART_SEGMENTS)]
    rules += [enum_rule(c, ["Yes", "No"]) for c in ("urgent", "low", "pending")]
    rules += [range_rule(c, ge=0) for c in ("c_acctbal", "n_orders", "total_spend", "tenure_days")]
    rules += [required_rule(c, t) for c, t in (("c_mktsegment", None), ("urgent", None), ("low", None),
                                                ("pending", None), ("c_acctbal", "double"),
                                                ("n_orders", "bigint"), ("total_spend", "double"),
                                                ("tenure_days", "int"))]
    if with_cross:
        rules.append(implies_rule("urgent", F.col("low") == "Yes", F.col("urgent") == "No"))
    return rules
