"""Classification metrics per group (fold, batch, whole table).

Input rows carry a 0/1 label ``y``, a score ``p`` and optionally a hard
prediction.  Rows with a null label are ignored by label metrics.  All
threshold metrics come from one ``groupBy(...).agg`` (map-side partial
aggregation, one shuffle of tiny partial rows).  ROC AUC is exact: counts per
distinct score, a distributed prefix sum of negatives, ties counted one half.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import clip, decide, safe_ratio
from tidemark.operators.joins import join_keys
from tidemark.operators.materialize import materialize
from tidemark.operators.rank import default_bucket_count, dist_cumsum, with_quantile_bucket

# Decision threshold; log-loss clipping in monitoring (1e-6)
# and in training (machine epsilon of a double).
THRESHOLD = 0.5
LOGLOSS_EPS = 1e-6
TRAINING_EPS = 2.220446049250313e-16


def _g(group_by):
    return [group_by] if isinstance(group_by, str) else list(group_by or [])


def scored(p: str = "p"):
    """Rows with a usable score: null and NaN scores are left out of label metrics (and counted)."""
    return F.col(p).isNotNull() & ~F.isnan(F.col(p).cast("double"))


def confusion_aggs(y: str = "y", pred: str = "pred", p: str | None = None):
    yc, pc = F.col(y), F.col(pred)
    lab = yc.isNotNull() & (scored(p) if p else F.lit(True))
    return {
        "tp": F.sum(F.when(lab & (yc == 1) & (pc == 1), 1).otherwise(0)).cast("long"),
        "fp": F.sum(F.when(lab & (yc == 0) & (pc == 1), 1).otherwise(0)).cast("long"),
        "fn": F.sum(F.when(lab & (yc == 1) & (pc == 0), 1).otherwise(0)).cast("long"),
        "tn": F.sum(F.when(lab & (yc == 0) & (pc == 0), 1).otherwise(0)).cast("long"),
    }


def threshold_metrics(df: DataFrame, group_by=None, y: str = "y", p: str = "p",
                      pred: str | None = None, threshold: float = THRESHOLD,
                      eps: float = LOGLOSS_EPS) -> DataFrame:
    """Confusion counts, accuracy, precision, recall, F1, log loss, rates.

    Precision/recall/F1 are 0 when their denominator is 0; accuracy, log loss
    and positive rate are null when the group has no labelled row.  Labelled
    rows with a null or NaN score are left out and counted in ``n_unscored``.
    """
    g = _g(group_by)
    d = df.withColumn("_pred", F.col(pred).cast("int") if pred else decide(p, threshold))
    pc = clip(p, eps, 1 - eps)
    yc = F.col(y)
    ll = -(yc * F.log(pc) + (1 - yc) * F.log(1 - pc))
    conf = confusion_aggs(y, "_pred", p)
    lab = yc.isNotNull() & scored(p)
    agg = d.groupBy(*g).agg(
        *[v.alias(k) for k, v in conf.items()],
        F.count(F.when(lab, 1)).alias("n_labelled"),
        F.count(F.when(yc.isNotNull() & ~scored(p), 1)).alias("n_unscored"),
        F.avg(F.when(lab, (yc == F.col("_pred")).cast("double"))).alias("accuracy"),
        F.avg(F.when(lab, ll)).alias("log_loss"),
        F.avg(F.when(lab, yc.cast("double"))).alias("positive_rate"),
        F.avg(F.when(scored(p), F.col(p))).alias("mean_score"),
    )
    return (agg
            .withColumn("precision", safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")))
            .withColumn("recall", safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")))
            .withColumn("f1", safe_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))))


def score_counts(df: DataFrame, group_by=None, y: str = "y", p: str = "p",
                 n_buckets: int | None = None, bounded: bool = False) -> DataFrame:
    """Positives/negatives per distinct score with the running count of
    negatives (inclusive) in ascending score order, per group.  ``bounded``:
    groups are small by definition (batches of fixed size)."""
    g = _g(group_by)
    nb = n_buckets or default_bucket_count(df.sparkSession)
    d = df.filter(F.col(y).isNotNull() & scored(p))
    if bounded and g:  # all rows of a batch meet once: counted, then summed up in score order
        d = d.select(*g, p, y).repartition(*g)
    c = (d.groupBy(*g, F.col(p).alias("score"))
           .agg(F.sum(F.col(y).cast("long")).alias("pos"),
                F.sum((1 - F.col(y)).cast("long")).alias("neg")))
    sums = {"cum_neg": "neg", "cum_pos": "pos"}
    if bounded:
        return dist_cumsum(c, g, ["score"], None, sums)
    c = materialize(c, "score-counts")  # scores may crowd anywhere in [0, 1]: buckets by share
    return dist_cumsum(with_quantile_bucket(c, g, "score", nb, name="_sb"), g, ["score"], "_sb", sums).drop("_sb")


def roc_auc(df: DataFrame, group_by=None, y: str = "y", p: str = "p",
            n_buckets: int | None = None, bounded: bool = False) -> DataFrame:
    """Exact ROC AUC per group over scored rows; null when a group has one class only."""
    g = _g(group_by)
    c = score_counts(df, g, y, p, n_buckets, bounded)
    per = c.groupBy(*g).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2.0)).alias("_s"),
        F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    auc = F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                 F.col("_s") / (F.col("_P").cast("double") * F.col("_N").cast("double")))
    return per.select(*g, auc.alias("roc_auc"))


def roc_points(df: DataFrame, group_by=None, y: str = "y", p: str = "p",
               n_buckets: int | None = None) -> DataFrame:
    """ROC curve points: for each distinct score t, TPR and FPR of ``p >= t``."""
    g = _g(group_by)
    c = score_counts(df, g, y, p, n_buckets)
    tot = c.groupBy(*g).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    j = join_keys(c, tot, g, "inner") if g else c.crossJoin(F.broadcast(tot))
    return j.select(
        *g, F.col("score").alias("threshold"),
        safe_ratio(F.col("_P") - F.col("cum_pos") + F.col("pos"), F.col("_P")).alias("tpr"),
        safe_ratio(F.col("_N") - F.col("cum_neg") + F.col("neg"), F.col("_N")).alias("fpr"))


def classification_metrics(df: DataFrame, group_by=None, y: str = "y", p: str = "p",
                           pred: str | None = None, threshold: float = THRESHOLD,
                           n_buckets: int | None = None, eps: float = LOGLOSS_EPS, bounded: bool = False) -> DataFrame:
    """All metrics of one group in one row: threshold metrics joined to AUC."""
    g = _g(group_by)
    t = threshold_metrics(df, g, y, p, pred, threshold, eps)
    a = roc_auc(df, g, y, p, n_buckets, bounded)
    if not g:
        return t.crossJoin(a)
    return join_keys(t, a, g, "left")


def cv_summary(fold_metrics: DataFrame, by=("family", "metric"), value: str = "value") -> DataFrame:
    """Mean and population std over folds (long input: family, fold, metric, value)."""
    return fold_metrics.groupBy(*by).agg(F.avg(value).alias("mean"),
                                         F.stddev_pop(value).alias("std"))


def ensemble_auc(fold_metrics: DataFrame) -> DataFrame:
    """Mean of the per-family mean AUCs (not the AUC of the mean score)."""
    fam = (fold_metrics.filter(F.col("metric") == "auc")
           .groupBy("family").agg(F.avg("value").alias("mean_auc")))
    return fam.agg(F.avg("mean_auc").alias("ensemble_auc"))


def calibration(df: DataFrame, group_by, y: str = "y", p: str = "p") -> DataFrame:
    """Mean predicted vs. actual positive rate per group, long form."""
    g = _g(group_by)
    wide = df.groupBy(*g).agg(F.avg(F.col(p)).alias("mean_predicted"),
                              F.avg(F.col(y).cast("double")).alias("churn_rate"))
    return wide.unpivot(g, ["mean_predicted", "churn_rate"], "metric", "value")


__all__ = ["threshold_metrics", "roc_auc", "roc_points", "classification_metrics",
           "score_counts", "cv_summary", "ensemble_auc", "calibration"]
