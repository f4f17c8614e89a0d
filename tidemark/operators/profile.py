"""Profiling aggregates (EDA): shape, column info, nulls, duplicates,
distinct counts, skewness, correlations, histograms, densities,
contingency counts, score summaries.

Wide aggregates are computed in one ``agg`` and only the small result is
unpivoted; nothing is collected per row.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.operators.joins import join_keys
from tidemark.operators.materialize import materialize
from tidemark.operators.rank import default_bucket_count, dist_cumsum, with_quantile_bucket


def _q(c):
    return F.col("`" + c + "`")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def column_info(df: DataFrame) -> DataFrame:
    """(column, position, kind, non_null) — counts from one aggregation."""
    kinds = {f.name: ("numeric" if isinstance(f.dataType, NumericType) else "string")
             for f in df.schema.fields}
    wide = df.agg(*[F.count(_q(c)).alias(c) for c in df.columns])
    long = wide.unpivot([], list(df.columns), "column", "non_null")
    meta = df.sparkSession.createDataFrame(
        [(c, i, kinds[c]) for i, c in enumerate(df.columns)], "column string, position int, kind string")
    return long.join(F.broadcast(meta), "column")


def null_counts(df: DataFrame) -> DataFrame:
    wide = df.agg(*[F.sum(_q(c).isNull().cast("long")).alias(c) for c in df.columns])
    return wide.unpivot([], list(df.columns), "column", "nulls")


def duplicate_rows(df: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row on ``key`` (all columns by default)."""
    k = list(key or df.columns)
    return (df.groupBy(*[_q(c) for c in k]).agg(F.count(F.lit(1)).alias("_n"))
              .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates")))


def distinct_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    f = (lambda c: F.approx_count_distinct(_q(c))) if approx else (lambda c: F.count_distinct(_q(c)))
    wide = df.agg(*[f(c).alias(c) for c in df.columns])
    return wide.unpivot([], list(df.columns), "column", "n_distinct")


def skewness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bias-adjusted sample skewness ``g1 * sqrt(n(n-1))/(n-2)`` per column."""
    aggs = []
    for c in columns:
        aggs += [F.skewness(_q(c)).alias(f"{c}__g1"), F.count(_q(c)).alias(f"{c}__n")]
    row = df.agg(*aggs)
    adj = [(F.col(f"`{c}__g1`") * F.sqrt(F.col(f"`{c}__n`") * (F.col(f"`{c}__n`") - 1))
            / (F.col(f"`{c}__n`") - 2)).alias(c) for c in columns]
    return row.select(*adj).unpivot([], list(columns), "column", "skewness")


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, long form ``(a, b, corr)``.

    Each pair uses the rows where both are non-null, at any width.  One pass
    over Arrow batches adds up products of zero-filled centred values, their
    squares and presence masks (four small matrix products per batch); partial
    sums per task are added by an aggregate over the pairs.  Centring by the
    column means keeps the sums accurate.  A pair without variance is null.
    """
    cols = list(columns)
    k = len(cols)
    sel = df.select(*[_q(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    means = sel.agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(k)]).first()
    centre = [float(m) if m is not None and math.isfinite(m) else 0.0 for m in means]

    def gram(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((4, k, k))  # rows of both; sums of a; sums of a squared; products
        for batch in batches:
            x = np.column_stack([np.asarray(c.to_numpy(zero_copy_only=False), float) for c in batch.columns])
            there = ~np.column_stack([np.asarray(c.is_null()) for c in batch.columns])
            x = np.where(there, x - centre, 0.0)
            m = there.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        i, j = np.divmod(np.arange(k * k), k)
        names = ("n", "s", "ss", "p")
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *(pa.array(t.ravel()) for t in total)], names=["i", "j", *names])

    sums = (sel.mapInArrow(gram, "i long, j long, n double, s double, ss double, p double")
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss", "p")]))
    # sums of b come from the mirrored pair: least / greatest make both rows meet
    pair = sums.groupBy(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).agg(
        F.max("n").alias("n"), F.max("p").alias("p"),
        *[F.max(F.when(F.col("i") <= F.col("j"), F.col(c))).alias(f"{c}a") for c in ("s", "ss")],
        *[F.max(F.when(F.col("i") >= F.col("j"), F.col(c))).alias(f"{c}b") for c in ("s", "ss")])
    cov = F.col("p") - F.col("sa") * F.col("sb") / F.col("n")
    var = (F.col("ssa") - F.col("sa") * F.col("sa") / F.col("n")) * (F.col("ssb") - F.col("sb") * F.col("sb") / F.col("n"))
    corr = F.when(F.col("a") == F.col("b"), F.lit(1.0)).when((F.col("n") > 1) & (var > 0), cov / F.sqrt(var))
    names = F.array(*[F.lit(c) for c in cols])
    upper = pair.select("a", "b", corr.alias("corr"))
    both = upper.select("corr", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))).alias("x"))
    return both.select(F.element_at(names, (F.col("x.a") + 1).cast("int")).alias("a"),
                       F.element_at(names, (F.col("x.b") + 1).cast("int")).alias("b"), "corr")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram over [min, max]; last bin closed; empty bins kept."""
    st = df.agg(F.min(_q(column)).cast("double").alias("lo"), F.max(_q(column)).cast("double").alias("hi"))
    w = (F.col("hi") - F.col("lo")) / bins
    binned = (df.select(_q(column).cast("double").alias("x")).filter(F.col("x").isNotNull())
              .crossJoin(F.broadcast(st))  # one row
              .select(F.when(F.col("hi") == F.col("lo"), 0)
                      .otherwise(F.least(F.floor((F.col("x") - F.col("lo")) / w), F.lit(bins - 1)))
                      .cast("int").alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    grid = st.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.join(binned, "bin", "left")
            .select("bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("lower"),
                    (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def density(df: DataFrame, column: str, by: str, grid_points: int = 200, fine_bins: int = 1024) -> DataFrame:
    """Gaussian kernel density per class, each class normalised alone.

    Rows are reduced to a fine histogram per class (bin centres); the grid of
    ``grid_points`` spans the global [min, max] and the estimate is
    ``sum(n_b * phi((g - x_b)/h)) / (n h)`` with Scott's bandwidth
    ``h = std * n^(-1/5)``.  Bins are at most ``h / 8`` wide for the smallest
    bandwidth of a class, and there are ``fine_bins`` at least.  A value is then
    at most ``h / 16`` from its centre, so the estimate differs from the unbinned
    one by less than ``max|phi'| / 16 / h = 0.0152 / h`` (3.8% of the kernel's
    peak) at every grid point.  Only bins that hold values are rows: work after
    the first aggregation is ``occupied bins x grid_points``.
    """
    x = _q(column).cast("double")
    base = df.select(F.col(by).alias("cls"), x.alias("x")).filter(F.col("x").isNotNull())
    st = base.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    cls = base.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"))
    h = F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))
    st = st.crossJoin(cls.agg(F.min(F.when(h > 0, h)).alias("h0")))  # one row each
    span = F.col("hi") - F.col("lo")
    bins = F.greatest(F.lit(float(fine_bins)), F.ceil(8 * span / F.col("h0")).cast("double"))  # greatest skips null
    width = F.greatest(span / bins, F.lit(1e-12))
    fine = (base.crossJoin(F.broadcast(st))
            .withColumn("b", F.least(F.floor((F.col("x") - F.col("lo")) / width).cast("double"), bins - 1))
            .groupBy("cls", "b").agg(F.count(F.lit(1)).alias("nb"))
            .crossJoin(F.broadcast(st))
            .withColumn("xb", F.col("lo") + (F.col("b") + 0.5) * width))
    grid = st.select(F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("gi"), "lo", "hi") \
             .select("gi", (F.col("lo") + F.col("gi") * (F.col("hi") - F.col("lo")) / (grid_points - 1)).alias("g"))
    k = F.col("nb") * F.exp(-0.5 * F.pow((F.col("g") - F.col("xb")) / h, 2))
    j = join_keys(fine, cls, ["cls"]).crossJoin(F.broadcast(grid))  # grid: grid_points rows
    return (j.groupBy("cls", "gi", "g", "n", "sd")
            .agg(F.sum(k).alias("_s"))
            .select(F.col("cls").alias(by), "gi", "g",
                    (F.col("_s") / (F.col("n") * h * F.lit(math.sqrt(2 * math.pi)))).alias("density")))


def linear_density(df: DataFrame, column: str, by: str, grid_points: int = 200, fine_bins: int = 1024) -> DataFrame:
    """Gaussian kernel density per class as :func:`density`, by linear binning: ``(by, gi, g, density, error)``.

    A value is shared between the two neighbouring nodes in proportion to its
    nearness, which is linear interpolation of the kernel: the estimate differs
    from the unbinned one by at most ``width^2 max|phi''| / (8 h^3)`` at every
    grid point (``error``; second order - 0.2% of the kernel's peak at ``h / 8``
    wide bins, 3.8% with values moved to bin centres).  Classes without spread
    (or a single value) have no bandwidth and no density.
    """
    x = _q(column).cast("double")
    base = df.select(F.col(by).alias("cls"), x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    cls = base.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    h = F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))
    st = cls.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min(F.when(h > 0, h)).alias("h0"))  # one row
    span = F.col("hi") - F.col("lo")
    bins = F.greatest(F.lit(float(fine_bins)), F.ceil(8 * span / F.col("h0")).cast("double"))  # greatest skips null
    st = st.select("lo", "hi", F.greatest(span / bins, F.lit(1e-12)).alias("width"))
    at = (F.col("x") - F.col("lo")) / F.col("width")
    node = F.floor(at).cast("double")
    shared = (base.crossJoin(F.broadcast(st)).select("cls", F.explode(F.array(
        F.struct(node.alias("b"), (node + 1 - at).alias("w")), F.struct((node + 1).alias("b"), (at - node).alias("w")))).alias("_s"))
        .groupBy("cls", F.col("_s.b").alias("b")).agg(F.sum("_s.w").alias("nb")).filter("nb > 0"))
    fine = shared.crossJoin(F.broadcast(st)).withColumn("xb", F.col("lo") + F.col("b") * F.col("width"))
    grid = st.select(F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("gi"), "lo", "hi") \
             .select("gi", (F.col("lo") + F.col("gi") * (F.col("hi") - F.col("lo")) / (grid_points - 1)).alias("g"))
    k = F.col("nb") * F.exp(-0.5 * F.pow((F.col("g") - F.col("xb")) / h, 2))
    j = join_keys(fine, cls.select("cls", "n", "sd"), ["cls"]).filter(h > 0).crossJoin(F.broadcast(grid))  # grid: grid_points rows
    peak = F.lit(math.sqrt(2 * math.pi))
    return (j.groupBy("cls", "gi", "g", "n", "sd", "width").agg(F.sum(k).alias("_s"))
            .select(F.col("cls").alias(by), "gi", "g", (F.col("_s") / (F.col("n") * h * peak)).alias("density"),
                    (F.col("width") * F.col("width") / (8 * h * h * h * peak)).alias("error")))


def contingency(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Counts of every category of every column by class: one unpivot, one groupBy."""
    sel = df.select(_q(by).alias("_by"), *[_q(c).cast("string").alias(c) for c in columns])
    long = sel.unpivot(["_by"], list(columns), "column", "value")
    return long.groupBy("column", "value", F.col("_by").alias(by)).agg(F.count(F.lit(1)).alias("count"))


def exact_median(df: DataFrame, column: str, group_by: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """Exact median (mean of the two middle values) from running counts.

    Rows are first reduced to counts per distinct value, so ties - a 0/1
    column, say - cost a row; the running counts are a distributed prefix sum.
    """
    g = list(group_by)
    nb = n_buckets or default_bucket_count(df.sparkSession)
    c = (df.select(*g, _q(column).cast("double").alias("x")).filter(F.col("x").isNotNull())
         .groupBy(*g, "x").agg(F.count(F.lit(1)).alias("_k")))
    c = materialize(c, "value-counts")
    cnt = c.groupBy(*g).agg(F.sum("_k").alias("_n"))
    r = dist_cumsum(with_quantile_bucket(c, g, "x", nb, name="_qb"), g, ["x"], "_qb", {"_r": "_k"})
    r = join_keys(r, cnt, g, "inner") if g else r.crossJoin(F.broadcast(cnt))
    lo, hi = F.floor((F.col("_n") + 1) / 2), F.ceil((F.col("_n") + 1) / 2)
    holds = lambda at: (F.col("_r") >= at) & (F.col("_r") - F.col("_k") < at)
    mid = r.filter(holds(lo) | holds(hi))
    return mid.groupBy(*g).agg((F.min("x") / 2 + F.max("x") / 2).alias("median"))


def score_summary(df: DataFrame, column: str, group_by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """Mean, population std, median (exact by default; ``approx`` uses the
    mergeable ``percentile_approx`` sketch in the same aggregation), min, max."""
    g = list(group_by)
    aggs = [F.avg(_q(column)).alias("mean"), F.stddev_pop(_q(column)).alias("std"),
            F.min(_q(column)).cast("double").alias("min"), F.max(_q(column)).cast("double").alias("max")]
    if approx:
        return df.groupBy(*g).agg(*aggs, F.percentile_approx(_q(column).cast("double"), 0.5, 10000)
                                  .alias("median"))
    s = df.groupBy(*g).agg(*aggs)
    m = exact_median(df, column, g)
    return join_keys(s, m, g, "inner") if g else s.crossJoin(m)


def head(df: DataFrame, n: int = 5, order: str = "id") -> DataFrame:
    """First n rows by key (top-k: TakeOrderedAndProject, no full sort)."""
    return df.orderBy(order).limit(n)


def sample_rows(df: DataFrame, n: int, seed, key: str = "id") -> DataFrame:
    """n reproducible 'random' rows: smallest hash draws."""
    from tidemark.functions.columns import hash_uniform
    return df.withColumn("_u", hash_uniform(seed, key)).orderBy("_u", key).limit(n).drop("_u")
