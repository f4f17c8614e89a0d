"""Drift on a fixed grid of reference quantiles, from counts that add up.

A numeric column is described by the reference quantiles ``i / points`` as bin
edges (ties merged; the outer edges are the exact minimum and maximum).  A
group of current rows needs one aggregate only: per column and bin the number
of values and the sum of their distances to the bin's left edge.  Both merge,
so the same counts serve batches, windows of a stream and parts of either.

Count and distance sum give the *exact* integral of the empirical CDF over each
bin.  Where reference and current CDF do not cross inside a bin, the difference
of the integrals is the bin's share of the Wasserstein-1 distance, exactly;
where they may cross it is a lower bound, and the bin's width times the largest
possible gap an upper one.  So for every group

    wasserstein <= W1 <= wasserstein + wasserstein_error

with an error summed over the bins whose CDF ranges overlap (each at most a
bin's width times the reference and current mass in it).  The same holds for
the Kolmogorov-Smirnov statistic (largest gap at an edge, and what the bins
leave open) and for the ROC AUC of a score with labels (pairs within a bin can
be in either order).

Values outside the reference range fall in the two outer bins, where the
reference CDF is 0 or 1 and the integral is exact.  Null and NaN values are
missing: counted, in no bin.  A column without reference values has no bins and
no drift.  The grid has at most ``columns x (points + 2)`` rows; it is the only
table that is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import clip, decide
from tidemark.operators.drift import CATEGORICAL_THRESHOLD, NUMERIC_THRESHOLD, reference_shares, to_long
from tidemark.operators.evaluate import LOGLOSS_EPS
from tidemark.operators.joins import join_keys
from tidemark.operators.materialize import materialize

POINTS = 256
#: sketch size: ranks are exact below this many reference values, off by n / ACCURACY above
ACCURACY = 100_000
MISSING = -1

COUNTS = ["n", "dist", "pos", "neg", "hits", "loss"]


@dataclass(frozen=True)
class Grid:
    """Edges per numeric column; ``bins``: a row per column with its reference arrays; ``shares`` of categories."""
    edges: dict
    categorical: tuple
    bins: DataFrame
    shares: DataFrame

    @property
    def numeric(self) -> list[str]:
        return list(self.edges)


def quantile_edges(reference: DataFrame, columns: Sequence[str], points: int = POINTS) -> tuple[dict[str, list[float]], dict[str, float]]:
    """({column: increasing edges}, {column: population deviation, 1 for none}); one aggregate over the reference."""
    probs = F.array(*[F.lit(i / points) for i in range(points + 1)])
    value = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in columns}
    aggs = [a for i, c in enumerate(columns) for a in (F.percentile_approx(value[c], probs, ACCURACY).alias(f"q{i}"), F.min(value[c]).alias(f"lo{i}"),
                                                       F.max(value[c]).alias(f"hi{i}"), F.stddev_pop(value[c]).alias(f"sd{i}"))]
    row = reference.agg(*aggs).first()
    edges, spread = {}, {}
    for i, c in enumerate(columns):
        inner = [x for x in (row[f"q{i}"] or []) if row[f"lo{i}"] < x < row[f"hi{i}"]]
        edges[c] = sorted({x + 0.0 for x in [*inner, *(x for x in (row[f"lo{i}"], row[f"hi{i}"]) if x is not None)]})
        spread[c] = row[f"sd{i}"] if row[f"sd{i}"] and row[f"sd{i}"] > 0 else 1.0
    return edges, spread


def _binned(df: DataFrame, edges: dict) -> DataFrame:
    """Adds ``_bin<i>`` (``MISSING`` without a value) and ``_dist<i>`` for every numeric column: binary search, no shuffle."""
    for i, (c, e) in enumerate(edges.items()):
        value = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
        df = df.withColumn(f"_x{i}", value)
        if not e:
            df = df.withColumn(f"_bin{i}", F.lit(MISSING)).withColumn(f"_dist{i}", F.lit(0.0))
            continue
        found = Bucketizer(splits=[float("-inf"), *e, float("inf")], inputCol=f"_x{i}", outputCol=f"_b{i}", handleInvalid="keep")
        df = found.transform(df)
        left = F.element_at(F.array(*[F.lit(x) for x in e]), F.greatest(F.col(f"_b{i}").cast("int"), F.lit(1)))
        has = F.col(f"_x{i}").isNotNull()
        df = df.withColumn(f"_bin{i}", F.when(has, F.col(f"_b{i}").cast("int")).otherwise(F.lit(MISSING)))
        df = df.withColumn(f"_dist{i}", F.when(has, F.abs(F.col(f"_x{i}") - left)).otherwise(F.lit(0.0)))
    return df


def slot_rows(df: DataFrame, edges: dict, categorical: Sequence[str], keep: Sequence[str], y: str | None = None, p: str | None = None) -> DataFrame:
    """(keep..., column, bin, value, and the numbers of ``COUNTS``): a row per input row and column.

    Numeric columns have a ``bin``, categorical ones a ``value`` (null where missing).
    Labels enter with the score column ``p`` only; unlabelled rows and missing scores have none.
    """
    d = _binned(df, edges)
    yc = F.col(f"`{y}`") if y else F.lit(None).cast("int")
    zero, none = F.lit(0.0), F.lit(None).cast("string")

    def slot(column: str, bin_: Column, value: Column, dist: Column, score: Column | None):
        lab = (yc.isNotNull() & (bin_ != MISSING)) if score is not None else F.lit(False)
        pc = clip(score, LOGLOSS_EPS, 1 - LOGLOSS_EPS) if score is not None else zero
        return F.struct(F.lit(column).alias("column"), bin_.cast("int").alias("bin"), value.alias("value"), F.lit(1).cast("long").alias("n"), dist.alias("dist"),
                        F.when(lab & (yc == 1), 1).otherwise(0).cast("long").alias("pos"), F.when(lab & (yc == 0), 1).otherwise(0).cast("long").alias("neg"),
                        F.when(lab & (yc == decide(score)), 1).otherwise(0).cast("long").alias("hits") if score is not None else F.lit(0).cast("long").alias("hits"),
                        F.when(lab, -(yc * F.log(pc) + (1 - yc) * F.log(1 - pc))).otherwise(zero).alias("loss") if score is not None else zero.alias("loss"))

    slots = [slot(c, F.col(f"_bin{i}"), none, F.col(f"_dist{i}"), F.col(f"_x{i}") if c == p else None) for i, c in enumerate(edges)]
    slots += [slot(c, F.lit(MISSING), F.col(f"`{c}`").cast("string"), zero, None) for c in categorical]
    return d.select(*keep, F.explode(F.array(*slots)).alias("_s")).select(*keep, "_s.*")


def slot_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The aggregate: a row per key, column and slot.  Adds up over any split of the rows."""
    return rows.groupBy(*keys, "column", "bin", "value").agg(*[F.sum(c).alias(c) for c in COUNTS])


BINS_SCHEMA = "column string, ref_n long, ref_std double, ref array<struct<bin: int, lo: double, hi: double, dist: double, width: double>>"


def build_grid(reference: DataFrame, numeric: Sequence[str], categorical: Sequence[str], points: int = POINTS) -> Grid:
    """Edges by one aggregate, reference counts by another (at most ``columns x (points + 2)`` rows, on the driver); shares are written."""
    edges, spread = quantile_edges(reference, numeric, points)
    spark = reference.sparkSession
    cells = {(r["column"], r["bin"]): r for r in slot_counts(slot_rows(reference, edges, (), ()), ()).filter(F.col("bin") >= 0).collect()}
    rows = []
    for c, e in edges.items():
        if not e:
            continue
        n = sum(r["n"] for (name, _), r in cells.items() if name == c)
        ref, below = [], 0
        for b in range(len(e) + 1):
            cell = cells.get((c, b))
            width = e[b] - e[b - 1] if 0 < b < len(e) else None
            upto = below + (cell["n"] if cell else 0)  # shares come from whole counts: equal shares are equal numbers
            ref.append((b, below / n, upto / n, cell["dist"] / n if cell else 0.0, width))
            below = upto
        rows.append((c, n, spread[c], ref))
    shares = reference_shares(to_long(reference, [], list(categorical), "string")) if categorical else \
        spark.createDataFrame([], "column string, value string, ref_count long, ref_total long, q double")
    return Grid(edges, tuple(categorical), spark.createDataFrame(rows, BINS_SCHEMA), materialize(shares, "grid-shares"))


def numeric_grid_drift(counts: DataFrame, keys: Sequence[str], grid: Grid, threshold: float = NUMERIC_THRESHOLD) -> DataFrame:
    """(keys..., column, cur_n, wasserstein, wasserstein_error, ks, ks_error, drift_score, drifted, pos, neg, auc_low, auc_high).

    A row per key and column with values; one shuffle.  ``drifted`` follows the
    lower bound; a null AUC has one class only (or no labels).
    """
    cells = counts.filter(F.col("bin") >= 0).groupBy(*keys, "column").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", F.struct("n", "dist", "pos", "neg")))).alias("c"),  # at most points + 2 entries
        F.sum("n").alias("cur_n"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    rows = cells.join(F.broadcast(grid.bins), "column")
    n = F.col("cur_n").cast("double")
    zero = F.lit(0.0)
    start = F.struct(F.lit(0).cast("long").alias("c"), zero.alias("w"), zero.alias("top"), zero.alias("ks"), zero.alias("kstop"),
                     F.lit(0).cast("long").alias("below"), zero.alias("low"), zero.alias("same"))

    def step(a, b):
        cell = F.col("c")[b["bin"]]
        upto, cd = a["c"] + F.coalesce(cell["n"], F.lit(0).cast("long")), F.coalesce(cell["dist"], zero) / n
        pos, neg = F.coalesce(cell["pos"], F.lit(0).cast("long")), F.coalesce(cell["neg"], F.lit(0).cast("long"))
        c_lo, c_hi, r_lo, r_hi = a["c"] / n, upto / n, b["lo"], b["hi"]
        # integrals of the CDFs over the bin; in the outer bins the distance sums are the integrals
        gap = F.when(b["width"].isNull(), F.abs(cd - b["dist"])).otherwise(F.abs((c_hi - r_hi) * b["width"] - (cd - b["dist"])))
        open_ = F.greatest(c_hi - r_lo, r_hi - c_lo)
        cross = b["width"].isNotNull() & (c_lo < r_hi) & (r_lo < c_hi)
        return F.struct(upto.alias("c"), (a["w"] + gap).alias("w"),
                        (a["top"] + F.when(cross, F.greatest(open_ * b["width"] - gap, zero)).otherwise(zero)).alias("top"),
                        F.greatest(a["ks"], F.abs(c_hi - r_hi)).alias("ks"),
                        F.greatest(a["kstop"], open_).alias("kstop"),
                        (a["below"] + neg).alias("below"), (a["low"] + pos * a["below"].cast("double")).alias("low"), (a["same"] + pos * neg.cast("double")).alias("same"))

    done = rows.withColumn("a", F.aggregate("ref", start, step))
    pairs = F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("pos").cast("double") * F.col("neg").cast("double"))
    score = F.col("a.w") / F.col("ref_std")
    return done.select(*keys, "column", "cur_n", F.col("a.w").alias("wasserstein"), F.col("a.top").alias("wasserstein_error"), F.col("a.ks").alias("ks"),
                       F.greatest(F.col("a.kstop") - F.col("a.ks"), zero).alias("ks_error"), score.alias("drift_score"), (score >= threshold).alias("drifted"),
                       "pos", "neg", (F.col("a.low") / pairs).alias("auc_low"), ((F.col("a.low") + F.col("a.same")) / pairs).alias("auc_high"))


def category_grid_drift(counts: DataFrame, keys: Sequence[str], grid: Grid, threshold: float = CATEGORICAL_THRESHOLD) -> DataFrame:
    """(keys..., column, jensen_shannon, drifted) from category counts; categories seen on one side only count."""
    c = counts.filter(F.col("value").isNotNull())
    total = c.groupBy(*keys, "column").agg(F.sum("n").alias("total"))
    j = join_keys(c, total, [*keys, "column"], "inner").join(grid.shares.select("column", "value", "q"), ["column", "value"], "left")
    share, q = F.col("n") / F.col("total"), F.coalesce("q", F.lit(0.0))
    mid = (share + q) / 2
    term = 0.5 * share * F.log2(share / mid) + F.when(q > 0, 0.5 * q * F.log2(q / mid)).otherwise(0.0)
    known = F.broadcast(grid.shares.select("column").distinct())  # a row per categorical column
    agg = j.join(known, "column").groupBy(*keys, "column").agg(F.sum(term).alias("js"), F.sum(q).alias("seen"))
    js = F.sqrt(F.greatest(F.col("js") + 0.5 * (1 - F.col("seen")), F.lit(0.0)))
    return agg.select(*keys, "column", js.alias("jensen_shannon"), (js >= threshold).alias("drifted"))


def grid_metrics(counts: DataFrame, keys: Sequence[str], grid: Grid, prediction: str, target: str | None = None) -> DataFrame:
    """One row per key from its slot counts: sizes, drift per kind, prediction drift, missing share and label metrics with AUC bounds.

    The target's own column counts as a drift column where the key has labels.
    """
    num = numeric_grid_drift(counts, keys, grid)
    cat = category_grid_drift(counts, keys, grid)
    is_p = F.col("column") == prediction
    of_num = num.groupBy(*keys).agg(
        F.sum(F.col("drifted").cast("int")).alias("_dn"), *[F.max(F.when(is_p, F.col(c))).alias(a) for c, a in (
            ("drift_score", "prediction_drift"), ("wasserstein", "prediction_w1"), ("wasserstein_error", "prediction_w1_error"), ("auc_low", "auc_low"), ("auc_high", "auc_high"))])
    of_cat = cat.groupBy(*keys).agg(F.sum(F.col("drifted").cast("int")).alias("_dc"), F.max("jensen_shannon").alias("max_js"))
    missing = F.when((F.col("bin") == MISSING) & F.col("value").isNull(), F.col("n")).otherwise(0)
    plain = F.lit(True) if target is None else F.col("column") != target
    labels = F.sum(F.col("pos") + F.col("neg"))
    base = counts.groupBy(*keys).agg(
        F.sum(F.when(is_p, F.col("n"))).alias("n"), F.sum(F.when(plain, missing).otherwise(0)).alias("_miss"), F.sum(F.when(~plain, missing).otherwise(0)).alias("_miss_y"),
        labels.alias("n_labelled"), F.sum("pos").alias("_pos"), F.sum("hits").alias("_hits"), F.sum("loss").alias("_loss"))
    out = reduce(lambda a, b: join_keys(a, b, list(keys), "left"), (of_num, of_cat), base)
    labelled = F.col("n_labelled") > 0
    n_plain = len(grid.edges) + len([c for c in grid.categorical if c != target])
    width = F.lit(n_plain) + F.when(labelled, 1 if target else 0).otherwise(0)
    known = lambda c: F.when(labelled, c / F.col("n_labelled"))
    n_drift = F.coalesce("_dn", F.lit(0)) + F.coalesce("_dc", F.lit(0))
    return out.select(*keys, "n", "n_labelled", n_drift.cast("int").alias("num_drifted_columns"), (n_drift / width).alias("share_drifted_columns"),
                      "prediction_drift", "prediction_w1", "prediction_w1_error", "max_js",
                      ((F.col("_miss") + F.when(labelled, F.col("_miss_y")).otherwise(0)) / (F.col("n") * width)).alias("share_missing_values"),
                      known(F.col("_pos")).alias("churn_rate"), known(F.col("_hits")).alias("accuracy"), known(F.col("_loss")).alias("log_loss"), "auc_low", "auc_high")
