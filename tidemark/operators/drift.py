"""Drift and missingness between a reference table and grouped current data.

Definitions (published statistics; method choice is ours):

* numeric: Wasserstein-1 distance of the empirical distributions divided by
  the population std of the reference (std 0 -> 1); drifted at >= 0.1.  The
  two-sample Kolmogorov–Smirnov statistic comes from the same frame.
* categorical: Jensen–Shannon distance (base 2, square root); categories seen
  on only one side count; drifted at >= 0.1.
* PSI on equal-width reference bins (empty bins floored), chi-square
  statistic against reference shares.

Scale: the reference is never copied into every group.  Exact W1 is
``mu_ref + sum_k [Phi(x_k, c_{k-1}) - Phi(x_k, c_k)]`` over the distinct values
``x_k`` of each group (``c_k`` the group CDF at ``x_k``), where
``Phi(x, c) = int |F_ref(t) - c| dt`` up to ``x``.  ``Phi`` needs only the
reference prefix sums at ``x`` (one distributed prefix sum over the union of
reference values and distinct probe values per column) and the first
reference value whose CDF reaches ``c`` (a distributed forward as-of lookup on
the CDF axis).  Work is linear in reference + current rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import join_keys
from tidemark.operators.materialize import materialize
from tidemark.operators.rank import default_bucket_count, dist_asof_next, dist_cumsum, unit_bucket, with_quantile_bucket

# Drift thresholds.
NUMERIC_THRESHOLD = 0.1
CATEGORICAL_THRESHOLD = 0.1
PSI_BINS = 10
PSI_FLOOR = 1e-4


def _g(group_by):
    return [group_by] if isinstance(group_by, str) else list(group_by or [])


def to_long(df: DataFrame, group_by, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """Unpivot ``columns`` to ``(group..., column, value)``; nulls dropped."""
    g = _g(group_by)
    sel = df.select(*g, *[F.col(f"`{c}`").cast(kind).alias(c) for c in columns])
    return (sel.unpivot(g, list(columns), "column", "value")
            .filter(F.col("value").isNotNull()))


def reference_stats(ref_long: DataFrame) -> DataFrame:
    """Per numeric column: count, mean, population std (0 -> 1), min, max."""
    return ref_long.groupBy("column").agg(
        F.count(F.lit(1)).alias("ref_n"), F.avg("value").alias("ref_mean"),
        F.stddev_pop("value").alias("ref_std_raw"),
        F.min("value").alias("ref_min"), F.max("value").alias("ref_max"),
    ).withColumn("ref_std", F.when(F.col("ref_std_raw") > 0, F.col("ref_std_raw")).otherwise(F.lit(1.0))) \
     .drop("ref_std_raw")


@dataclass
class ReferenceProfile:
    """The reference side of every drift statistic, computed once.

    ``counts``: ``(column, value, n_r)`` per distinct numeric value, centred by
    the column's mean and written; ``stats``: {column: row} with count, mean,
    std (0 -> 1), min, max and ``rest`` (what the rounded mean leaves: the mean of
    the centred values) - one row per column, on the driver; ``shares``:
    ``(column, value, ref_count, ref_total, q)`` per category, written if asked.
    A monitoring run or a stream builds it once instead of re-reading the
    reference for every batch.
    """
    counts: DataFrame | None
    stats: dict | None
    shares: DataFrame | None

    @staticmethod
    def build(ref_num_long: DataFrame | None, ref_cat_long: DataFrame | None,
              persist: bool = False) -> "ReferenceProfile":
        counts = stats = shares = None
        if ref_num_long is not None:
            raw = materialize(ref_num_long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_r")), "ref_counts")
            n, v = F.col("n_r"), F.col("value")
            first = {r["column"]: r.asDict() for r in raw.groupBy("column").agg(
                F.sum(n).alias("ref_n"), (F.sum(n * v) / F.sum(n)).alias("ref_mean"), F.min(v).alias("ref_min"), F.max(v).alias("ref_max")).collect()}
            counts = raw.withColumn("value", v - of_column(first, "ref_mean"))
            second = counts.groupBy("column").agg((F.sum(n * v) / F.sum(n)).alias("rest"), (F.sum(n * v * v) / F.sum(n)).alias("square")).collect()
            for r in second:
                var = r["square"] - r["rest"] ** 2
                first[r["column"]].update(rest=r["rest"], ref_std=math.sqrt(var) if var > 0 else 1.0)
            stats = first
        if ref_cat_long is not None:
            shares = reference_shares(ref_cat_long)
            shares = materialize(shares, "ref_shares") if persist else shares
        return ReferenceProfile(counts, stats, shares)


def of_column(stats: dict, field: str):
    """The number that belongs to a row's ``column`` (null for a column without reference values)."""
    known = [x for c, r in stats.items() for x in (F.lit(c), F.lit(float(r[field])))]
    return F.create_map(*known)[F.col("column")] if known else F.lit(None).cast("double")


def numeric_drift(ref_long: DataFrame | None, cur_long: DataFrame, group_by,
                  n_buckets: int | None = None, threshold: float = NUMERIC_THRESHOLD,
                  profile: ReferenceProfile | None = None, bounded: bool = False) -> DataFrame:
    """Exact W1 (raw and normalised) and KS per ``(group..., column)``.

    Values are centred by the reference mean first: neither statistic changes,
    and prefix sums of values far from zero keep their digits.  ``bounded``
    says that groups are small by definition (batches of fixed size).  Columns
    without reference values have no row.
    """
    g = _g(group_by)
    nb = n_buckets or default_bucket_count(cur_long.sparkSession)
    profile = profile or ReferenceProfile.build(ref_long, None)
    stats, rd = profile.stats, profile.counts
    ref_n = of_column(stats, "ref_n")
    known = cur_long.filter(F.col("column").isin(*stats)) if stats else cur_long.filter(F.lit(False))
    if bounded:  # all rows of a batch and column meet once: counted, then summed up in value order
        cd = known.repartition(*g, "column").groupBy(*g, "column", "value").agg(F.count(F.lit(1)).alias("n_c"))
        cd = dist_cumsum(cd, g + ["column"], ["value"], None, {"cum_c": "n_c"})
        cd = cd.withColumn("n", F.sum("n_c").over(Window.partitionBy(*g, "column")))  # same shuffle, same sort
    else:
        cd = known.groupBy(*g, "column", "value").agg(F.count(F.lit(1)).alias("n_c"))
    cd = materialize(cd.withColumn("value", F.col("value") - of_column(stats, "ref_mean")), "drift_counts")
    # The axis: reference values and the probe values of all groups, one row
    # for each distinct value (no join).  Its running count gives
    # F(x) = P(ref <= x); without the count at the value itself, P(ref < x).
    u = (rd.select("column", "value", "n_r", F.lit(False).alias("_probe"))
         .unionByName(cd.select("column", "value", F.lit(0).cast("long").alias("n_r"), F.lit(True).alias("_probe"))))
    u = materialize(u.groupBy("column", "value").agg(F.sum("n_r").alias("n_r"), F.max("_probe").alias("_probe")), "drift_axis")
    u = with_quantile_bucket(u, ["column"], "value", nb, name="_vb")
    u = dist_cumsum(u, ["column"], ["value"], "_vb",
                    {"cum_r": F.col("n_r").cast("double"), "cum_rv": F.col("n_r") * F.col("value")}, few_keys=True)
    merged = materialize(u.select(
        "column", "value", "n_r", "_probe", "_vb",
        (F.col("cum_r") / ref_n).alias("F"), ((F.col("cum_r") - F.col("n_r")) / ref_n).alias("F_lt"), (F.col("cum_rv") / ref_n).alias("S")), "drift_merged")

    # Group side: running count per (group, column) in value order.
    pts = cd.join(merged.filter("_probe").drop("_probe", "n_r"), ["column", "value"], "inner")
    if not bounded:
        n_tot = cd.groupBy(*g, "column").agg(F.sum("n_c").alias("n"))
        pts = join_keys(dist_cumsum(pts, g + ["column"], ["value"], "_vb", {"cum_c": "n_c"}), n_tot, g + ["column"], "inner")
    c_hi, c_lo = F.col("cum_c") / F.col("n"), (F.col("cum_c") - F.col("n_c")) / F.col("n")
    pts = pts.select(
        *g, "column", "value", "n", (F.col("value") * F.col("F") - F.col("S")).alias("G_x"), c_hi.alias("c_hi"), c_lo.alias("c_lo"),
        F.greatest(F.abs(F.col("F") - c_hi), F.abs(F.col("F_lt") - c_lo)).alias("_ks"))
    terms = _bounded_terms(cd, pts, merged, nb) if bounded else _terms(materialize(pts, "drift_points"), merged, g, cur_long, nb)
    w = terms.groupBy(*g, "column").agg(F.sum("_term").alias("_phi"), F.max("_ks").alias("ks"), F.max("n").alias("cur_n"))
    w1 = F.greatest(of_column(stats, "rest") + F.col("_phi"), F.lit(0.0))
    out = w.select(*g, "column", w1.alias("wasserstein"), "ks", (w1 / of_column(stats, "ref_std")).alias("drift_score"), "cur_n", ref_n.cast("long").alias("ref_n"))
    return out.withColumn("drifted", F.col("drift_score") >= F.lit(threshold))


def _bounded_terms(cd: DataFrame, pts: DataFrame, merged: DataFrame, nb: int) -> DataFrame:
    """``Phi(x, c_lo) - Phi(x, c_hi)`` of every point of small groups.

    Shares of groups of at most ``size`` rows are fractions j/n with n <= size:
    fewer than ``size ** 2 / 2`` of them, however many groups there are.  Each
    is looked up once on the CDF axis and joined back, in place of a lookup per
    point.  Both c_lo and c_hi lie on it; they are 0 and 1 at a group's ends.
    The axis is split evenly: a step of F is a reference row at least.
    """
    inner = (F.col("key") > 0) & (F.col("key") < 1)
    shares = cd.select("column", (F.col("cum_c") / F.col("n")).alias("key")).filter(inner).distinct()
    none = F.lit(None).cast("double")
    axis = shares.select("column", "key", F.lit(0).alias("side"), none.alias("m"), none.alias("G_m")).unionByName(
        merged.filter(F.col("n_r") > 0).select(
            "column", F.col("F").alias("key"), F.lit(1).alias("side"), F.col("value").alias("m"), (F.col("value") * F.col("F") - F.col("S")).alias("G_m")))
    axis = dist_asof_next(axis, ["column"], ["key", "side"], unit_bucket("key", nb), F.col("side") == 1, ["m", "G_m"], few_keys=True)
    found = materialize(axis.filter(F.col("side") == 0).select("column", "key", "_next_m", "_next_G_m"), "drift_lookups")
    for c in ("c_lo", "c_hi"):
        pts = pts.join(found.select("column", F.col("key").alias(c), F.col("_next_m").alias("m_" + c), F.col("_next_G_m").alias("G_" + c)), ["column", c], "left")
    x, G = F.col("value"), F.col("G_x")

    def phi(c):
        m, at = F.col("m_" + c), F.col(c)
        return F.when(at <= 0, G).when(at >= 1, x - G).when(x <= m, at * x - G).otherwise(at * (2 * m - x) + G - 2 * F.col("G_" + c))

    return pts.withColumn("_term", phi("c_lo") - phi("c_hi"))


def _terms(pts: DataFrame, merged: DataFrame, g: list[str], cur_long: DataFrame, nb: int) -> DataFrame:
    """The same terms of groups of any size, two rows for each point."""
    # Two probes per point: +Phi(x, c_lo) and -Phi(x, c_hi).  At c = 0 and c = 1
    # - the first and last point of every group - Phi needs no lookup: F never
    # lies below 0 or above 1, so Phi(x, 0) = G(x) and Phi(x, 1) = x - G(x).
    probes = pts.select(*g, "column", "value", "n", "G_x", "_ks", F.explode(F.array(
        F.struct(F.col("c_lo").alias("c"), F.lit(1.0).alias("sign")), F.struct(F.col("c_hi").alias("c"), F.lit(-1.0).alias("sign")))).alias("_pr")) \
        .select(*g, "column", "value", "n", "G_x", "_ks", "_pr.c", "_pr.sign")
    ends = (F.col("c") <= 0) | (F.col("c") >= 1)
    at_ends = probes.filter(ends).select(
        *g, "column", "n", "_ks", (F.col("sign") * F.when(F.col("c") <= 0, F.col("G_x")).otherwise(F.col("value") - F.col("G_x"))).alias("_term"))
    probe_rows = probes.filter(~ends).withColumn("key", F.col("c")).withColumn("side", F.lit(0)) \
        .withColumn("m", F.lit(None).cast("double")).withColumn("G_m", F.lit(None).cast("double"))
    ref_rows = merged.filter(F.col("n_r") > 0).select(
        *[F.lit(None).cast(t).alias(c) for c, t in _group_types(cur_long, g)],
        "column", *[F.lit(None).cast(t).alias(c) for c, t in (("value", "double"), ("n", "long"), ("G_x", "double"), ("_ks", "double"), ("c", "double"), ("sign", "double"))],
        F.col("F").alias("key"), F.lit(1).alias("side"),
        F.col("value").alias("m"), (F.col("value") * F.col("F") - F.col("S")).alias("G_m"))
    u = with_quantile_bucket(probe_rows.unionByName(ref_rows), ["column"], "key", nb, name="_cb")
    u = dist_asof_next(u, ["column"], ["key", "side"], "_cb", F.col("side") == 1, ["m", "G_m"], few_keys=True)
    phi = (F.when(F.col("value") <= F.col("_next_m"), F.col("c") * F.col("value") - F.col("G_x"))
           .otherwise(F.col("c") * (2 * F.col("_next_m") - F.col("value")) + F.col("G_x")
                      - 2 * F.col("_next_G_m")))
    inner = u.filter(F.col("side") == 0).select(*g, "column", "n", "_ks", (F.col("sign") * phi).alias("_term"))
    return inner.unionByName(at_ends)


def with_pvalues(num: DataFrame | None = None, cat: DataFrame | None = None):
    """Add KS and chi-square p-values (column expressions over the result rows)."""
    from tidemark.functions.stats import chi2_pvalue, ks_pvalue
    out = []
    if num is not None:
        out.append(num.withColumn("ks_pvalue", ks_pvalue("ks", "ref_n", "cur_n")))
    if cat is not None:
        out.append(cat.withColumn("chi2_pvalue", chi2_pvalue("chi2", "chi2_df"))
                   .withColumn("homogeneity_pvalue", chi2_pvalue("homogeneity", "homogeneity_df")))
    return out


def _group_types(df: DataFrame, g):
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    return [(c, types[c]) for c in g]


def reference_shares(ref_long: DataFrame) -> DataFrame:
    """Per categorical column and value: reference count and share."""
    c = ref_long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("ref_count"))
    t = ref_long.groupBy("column").agg(F.count(F.lit(1)).alias("ref_total"))
    return c.join(t, "column").withColumn("q", F.col("ref_count") / F.col("ref_total"))


def categorical_drift(ref_long: DataFrame | None, cur_long: DataFrame, group_by,
                      threshold: float = CATEGORICAL_THRESHOLD,
                      profile: ReferenceProfile | None = None, bounded: bool = False) -> DataFrame:
    """Jensen–Shannon distance and chi-square statistics per ``(group..., column)``.

    ``chi2`` is the goodness of fit to the reference shares; ``homogeneity``
    compares two samples: both counts against their pooled expectation, over
    the categories of either.  Reference categories absent from a group
    contribute ``q/2`` to the JS divergence, their expected count to chi-square
    and ``n q`` to homogeneity (its two terms for a count of 0), so only
    categories present in the group are joined — the reference is not copied per group.
    ``bounded``: groups are small by definition (batches of fixed size).
    """
    g = _g(group_by)
    shares = (profile or ReferenceProfile.build(None, ref_long)).shares
    ncat = shares.groupBy("column").agg(F.count(F.lit(1)).alias("n_ref_cats"), F.max("ref_total").alias("_r"))
    c = cur_long.groupBy(*g, "column", "value").agg(F.count(F.lit(1)).alias("n_c"))
    if bounded:
        c = c.withColumn("n", F.sum("n_c").over(Window.partitionBy(*g, "column")))
    else:
        c = join_keys(c, c.groupBy(*g, "column").agg(F.sum("n_c").alias("n")), g + ["column"], "inner")
    j = (c.join(shares.select("column", "value", "q", "ref_count"), ["column", "value"], "left")
         .fillna({"q": 0.0, "ref_count": 0})
         .join(ncat, "column", "inner")
         .withColumn("p", F.col("n_c") / F.col("n"))
         .withColumn("mid", (F.col("p") + F.col("q")) / 2))
    js_term = (0.5 * F.col("p") * F.log2(F.col("p") / F.col("mid"))
               + F.when(F.col("q") > 0, 0.5 * F.col("q") * F.log2(F.col("q") / F.col("mid"))).otherwise(0.0))
    e = F.col("n") * F.col("q")
    chi_term = F.when(F.col("q") > 0, (F.col("n_c") - e) * (F.col("n_c") - e) / e)
    # both terms of a category with counts c of n and r of R: n R (c/n - r/R)^2 / (c + r)
    apart = F.col("p") - F.col("q")
    pooled = F.col("n").cast("double") * F.col("_r") * apart * apart / (F.col("n_c") + F.col("ref_count"))
    agg = j.groupBy(*g, "column").agg(
        F.sum(pooled).alias("_pooled"), F.max("n_ref_cats").alias("n_ref_cats"), F.count(F.when(F.col("q") == 0, 1)).alias("_unseen_cats"),
        F.sum(js_term).alias("_js"), F.sum("q").alias("_q_seen"),
        F.sum(chi_term).alias("_chi_seen"), F.max("n").alias("_n"),
        F.sum(F.when(F.col("q") == 0, F.col("n_c")).otherwise(0)).alias("unseen_count"))
    out = agg.select(
        *g, "column",
        F.sqrt(F.greatest(F.col("_js") + 0.5 * (1 - F.col("_q_seen")), F.lit(0.0))).alias("jensen_shannon"),
        (F.coalesce(F.col("_chi_seen"), F.lit(0.0))
         + F.col("_n") * F.greatest(1 - F.col("_q_seen"), F.lit(0.0))).alias("chi2"),
        (F.col("n_ref_cats") - 1).alias("chi2_df"),
        (F.col("_pooled") + F.col("_n") * F.greatest(1 - F.col("_q_seen"), F.lit(0.0))).alias("homogeneity"),
        (F.col("n_ref_cats") + F.col("_unseen_cats") - 1).alias("homogeneity_df"),
        "unseen_count")
    return out.withColumn("drift_score", F.col("jensen_shannon")) \
              .withColumn("drifted", F.col("drift_score") >= F.lit(threshold))


def psi(ref_long: DataFrame, cur_long: DataFrame, group_by, bins: int = PSI_BINS,
        floor: float = PSI_FLOOR, binning: str = "width") -> DataFrame:
    """Population stability index per ``(group..., column)``.

    ``binning="width"``: equal-width bins over the reference [min, max], values
    outside fall in the edge bins.  ``binning="quantile"``: reference deciles
    (``bins`` equal-frequency bins from the approximate-percentile sketch;
    the bin is the number of boundaries at or below the value).  Empty shares
    are floored at ``floor``.  The bin grid is ``groups x columns x bins``.
    """
    g = _g(group_by)
    if binning == "quantile":
        probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
        st = ref_long.groupBy("column").agg(F.percentile_approx("value", probs, 10000).alias("bounds"))
        binexpr = F.size(F.filter(F.col("bounds"), lambda b: b <= F.col("value"))).cast("int")
    else:
        st = reference_stats(ref_long).select("column", "ref_min", "ref_max")
        width = F.greatest(F.col("ref_max") - F.col("ref_min"), F.lit(1e-12)) / bins
        binexpr = F.least(F.greatest(F.floor((F.col("value") - F.col("ref_min")) / width), F.lit(0)),
                          F.lit(bins - 1)).cast("int")
    rb = (ref_long.join(st, "column").withColumn("bin", binexpr)
          .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("r_n")))
    rt = rb.groupBy("column").agg(F.sum("r_n").alias("r_tot"))
    cb = (cur_long.join(st, "column").withColumn("bin", binexpr)
          .groupBy(*g, "column", "bin").agg(F.count(F.lit(1)).alias("c_n")))
    ct = cb.groupBy(*g, "column").agg(F.sum("c_n").alias("c_tot"))
    grid = (ct.select(*g, "column")
            .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))))
    j = (join_keys(join_keys(grid, cb, g + ["column", "bin"], "left"), ct, g + ["column"], "inner")
         .join(rb, ["column", "bin"], "left").join(rt, "column", "inner")
         .fillna({"c_n": 0, "r_n": 0}))
    a = F.greatest(F.col("c_n") / F.col("c_tot"), F.lit(floor))
    e = F.greatest(F.col("r_n") / F.col("r_tot"), F.lit(floor))
    return j.groupBy(*g, "column").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))


def missing_share(df: DataFrame, group_by, columns: Sequence[str]) -> DataFrame:
    """Null cells / (rows x columns) per group, one aggregation."""
    g = _g(group_by)
    nulls = None
    for c in columns:
        t = F.col(f"`{c}`").isNull().cast("long")
        nulls = t if nulls is None else nulls + t
    return df.groupBy(*g).agg(
        (F.sum(nulls) / (F.count(F.lit(1)) * F.lit(len(columns)))).alias("share_missing_values"))
