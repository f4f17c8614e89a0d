"""Key joins that treat null = null.

Group keys (pool, batch, class, fold) can be null; a plain equi-join would
drop such rows.  ``join_keys`` joins on ``<=>`` and keeps the left names;
the planner still uses hash / sort-merge joins (null-safe keys are
normalised to equi-join keys).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str] | str, how: str = "inner") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys:
        raise ValueError("no join keys; cross-join one-row tables explicitly")
    r = right.select(*[F.col(f"`{c}`").alias("_r_" + c) if c in keys else F.col(f"`{c}`") for c in right.columns])
    cond = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`")) for k in keys]
    out = left.join(r, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*["_r_" + k for k in keys])
