"""Feature construction: ratios, flag counts, dictionary maps, one-hot codes,
alignment to a frozen column list.

``FeatureSpec.fit`` learns the one-hot categories once (one aggregation,
``sort_array(collect_set(c))`` per column, partial-aggregated); the fitted
spec is reused for training, scoring and monitoring, so every table gets the
same columns in the same order.  ``transform`` is a single projection.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import count_equal, dict_map, smoothed_ratio

# The binary dictionary of the reference.
BINARY_MAP = {"Yes": 1, "No": 0}


def q(name: str):
    """Column by name; names may hold spaces or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns, ignoring absent ones."""
    return df.drop(*[n for n in names if n in df.columns])


def model_inputs(df: DataFrame, exclude: Sequence[str] = ("id", "gender", "Churn")) -> DataFrame:
    """All columns except identifiers and the target."""
    return df.select(*[q(c) for c in df.columns if c not in set(exclude)])


def typed_columns(df: DataFrame):
    """Split column names into numeric and other by Spark type."""
    from pyspark.sql.types import NumericType
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    oth = [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType)]
    return num, oth


def one_hot_columns(column: str, categories: Sequence[str], drop_first: bool = True):
    """Dummy columns ``column_value`` (int 0/1, null -> 0), first sorted category dropped."""
    cats = sorted(categories)[1:] if drop_first else sorted(categories)
    return [F.coalesce((q(column) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{column}_{v}") for v in cats]


def category_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value)`` of every observed category: one distributed distinct."""
    sel = df.select(*[q(c).cast("string").alias(c) for c in columns])
    return sel.unpivot([], list(columns), "column", "value").filter(F.col("value").isNotNull()).distinct()


def fit_categories(df: DataFrame, columns: Sequence[str], max_categories: int | None = None) -> dict:
    """Observed categories per column, sorted.

    The result names output columns, so it lives on the driver.  With
    ``max_categories`` a column that has more raises an error, and at most
    ``columns x (max_categories + 1)`` rows are fetched; by default there is
    no limit.
    """
    if not columns:
        return {}
    pairs = category_table(df, columns)
    rows = (pairs if max_categories is None else pairs.limit(len(columns) * (max_categories + 1) + 1)).collect()
    out = {c: [] for c in columns}
    for r in rows:
        out[r["column"]].append(r["value"])
    for c, v in out.items():
        if max_categories is not None and len(v) > max_categories:
            raise ValueError(f"{c}: more than {max_categories} categories")
        out[c] = sorted(v)
    return out


@dataclass(frozen=True)
class FeatureSpec:
    """Declarative feature recipe (fit once, transform many)."""
    id_col: str = "id"
    target: str | None = None
    target_map: dict = field(default_factory=lambda: dict(BINARY_MAP))
    ratio: tuple | None = None            # (numerator, denominator, name)
    flag_columns: tuple = ()
    flag_value: str = "Yes"
    flag_name: str = "TotalServices"
    binary_columns: tuple = ()
    binary_map: dict = field(default_factory=lambda: dict(BINARY_MAP))
    one_hot: tuple = ()
    drop: tuple = ()
    categories: dict | None = None        # fitted
    columns: tuple | None = None          # fitted, ordered feature names

    def fit(self, df: DataFrame) -> "FeatureSpec":
        cats = fit_categories(df, list(self.one_hot))
        spec = replace(self, categories=cats)
        cols = spec._plain_columns(df.columns)
        cols += [f"{c}_{v}" for c in self.one_hot for v in sorted(cats[c])[1:]]
        return replace(spec, columns=tuple(cols))

    def _plain_columns(self, input_cols) -> list[str]:
        skip = {self.id_col, self.target, *self.one_hot, *self.drop}
        cols = [c for c in input_cols if c not in skip]
        if self.ratio:
            cols.append(self.ratio[2])
        if self.flag_columns:
            cols.append(self.flag_name)
        return cols

    def transform(self, df: DataFrame, keep=("id",), with_target: bool = True) -> DataFrame:
        """One projection: keys, ordered features, optional encoded target.

        Columns of the fitted list that the input lacks are filled with 0;
        extra input columns are dropped (alignment).
        """
        if self.categories is None:
            raise ValueError("fit the spec first")
        exprs = {}
        for c in df.columns:
            if c in self.binary_columns:
                exprs[c] = dict_map(c, self.binary_map)
            else:
                exprs[c] = q(c)
        if self.ratio:
            exprs[self.ratio[2]] = smoothed_ratio(q(self.ratio[0]), q(self.ratio[1]))
        if self.flag_columns:
            exprs[self.flag_name] = count_equal([q(c) for c in self.flag_columns], self.flag_value)
        for c in self.one_hot:
            if c in df.columns:
                for e, v in zip(one_hot_columns(c, self.categories[c]), sorted(self.categories[c])[1:]):
                    exprs[f"{c}_{v}"] = e
        out = [q(k) for k in keep if k in df.columns]
        for name in self.columns:
            out.append((exprs[name] if name in exprs else F.lit(0)).alias(name))
        if with_target and self.target and self.target in df.columns:
            out.append(dict_map(self.target, self.target_map).cast("int").alias("label"))
        return df.select(*out)

    def to_json(self) -> str:
        return json.dumps({"columns": list(self.columns or []), "categories": self.categories})


def align_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Add missing columns as 0, drop extra ones, fix the order."""
    have = set(df.columns)
    return df.select(*[q(k) for k in keep if k in have],
                     *[(q(c) if c in have else F.lit(0)).alias(c) for c in columns])


# The churn mart's recipe: the reference's feature steps on the mart columns.
MART_SPEC = FeatureSpec(
    id_col="id", target="churn",
    ratio=("total_spend", "n_orders", "avg_spend"),
    flag_columns=("urgent", "low", "pending"), flag_name="n_flags",
    binary_columns=("urgent", "low", "pending"),
    one_hot=("c_mktsegment",),
)
