"""Queries: evaluation metrics, fold summaries, drift statistics, perturbation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import hash_uniform
from tidemark.operators import drift as D
from tidemark.operators import evaluate as EV
from tidemark.operators.rank import dist_rank, default_bucket_count, unit_bucket
from tidemark.plans.catalog import register
from tidemark.plans.fixtures import LABELLED_SOURCE, current_batches, current_slice, reference_slice, scored_events, with_batches
from tidemark.plans.monitoring import EVENTS_SPEC, drift_table
from tidemark.plans.sql import evaluation as S

G = ["data_source", "batch_id"]


def labelled_batches(spark, sf):
    """Batches of the labelled pool: the other pool is left out before rows are ranked; read once, so not written."""
    pool = current_slice(scored_events(spark, sf)).filter(F.col("data_source") == LABELLED_SOURCE)
    return with_batches(pool).filter(F.col("y").isNotNull())


def _tm(spark, sf):
    return EV.threshold_metrics(labelled_batches(spark, sf), G, "y", "p")


@register("confusion", S.CONF)
def q_confusion(spark, sf):
    return _tm(spark, sf).select(*G, "tp", "fp", "fn", "tn")


@register("accuracy", S.ACCURACY)
def q_accuracy(spark, sf):
    return _tm(spark, sf).select(*G, "accuracy")


@register("precision", S.PRECISION)
def q_precision(spark, sf):
    return _tm(spark, sf).select(*G, "precision")


@register("recall", S.RECALL)
def q_recall(spark, sf):
    return _tm(spark, sf).select(*G, "recall")


@register("f1", S.F1)
def q_f1(spark, sf):
    return _tm(spark, sf).select(*G, "f1")


@register("log_loss", S.LOG_LOSS)
def q_log_loss(spark, sf):
    return _tm(spark, sf).select(*G, "log_loss")


@register("roc_auc", S.ROC_AUC)
def q_roc_auc(spark, sf):
    return EV.roc_auc(labelled_batches(spark, sf), G, "y", "p")


@register("roc_points", S.ROC_POINTS)
def q_roc_points(spark, sf):
    return EV.roc_points(labelled_batches(spark, sf), G, "y", "p")


@register("calibration", S.CALIBRATION)
def q_calibration(spark, sf):
    return EV.calibration(labelled_batches(spark, sf), G, "y", "p")


def fold_metrics(spark, sf, metrics=("auc", "accuracy", "log_loss")):
    """Long fold metrics of two scoring families over stratified folds.

    Folds: rank by the hash draw within each class (distributed rank),
    ``fold = (rank - 1) mod 5``.  Family a scores with ``p``, family b with a
    second logistic score; each family is evaluated per fold in one grouped
    aggregation.
    """
    s = scored_events(spark, sf).filter(F.col("y").isNotNull())
    nb = default_bucket_count(spark)
    s = s.withColumn("_u", hash_uniform(42, "id"))
    s = dist_rank(s, ["y"], ["_u", "id"], unit_bucket("_u", nb), "_r") \
        .withColumn("fold", ((F.col("_r") - 1) % 5).cast("int"))
    a = s.select(F.lit("a").alias("family"), "fold", "y", "p")
    b = s.select(F.lit("b").alias("family"), "fold", "y",
                 F.round(1 / (1 + F.exp(-(F.col("value") - 40) / 60)), 6).alias("p"))
    both = a.unionByName(b)
    m = EV.classification_metrics(both, ["family", "fold"], "y", "p")
    return m.select("family", "fold", F.col("roc_auc").alias("auc"), "accuracy", "log_loss", "f1") \
            .unpivot(["family", "fold"], list(metrics), "metric", "value")


@register("fold_metrics", S.FOLD_METRICS)
def q_fold_metrics(spark, sf):
    return fold_metrics(spark, sf)


@register("cv_summary", S.CV_SUMMARY)
def q_cv_summary(spark, sf):
    return EV.cv_summary(fold_metrics(spark, sf))


@register("ensemble_auc", S.ENSEMBLE_AUC)
def q_ensemble_auc(spark, sf):
    return EV.ensemble_auc(fold_metrics(spark, sf))


# ---------------------------------------------------------------- drift

def _inputs(spark, sf):
    return reference_slice(scored_events(spark, sf)), current_batches(spark, sf)


NUM = ["value", "p"]
CAT = ["event_type", "y"]


@register("reference_profile", S.REF_PROFILE)
def q_ref_profile(spark, sf):
    ref, _ = _inputs(spark, sf)
    return D.reference_stats(D.to_long(ref, [], NUM))


@register("reference_shares", S.REF_SHARES)
def q_ref_shares(spark, sf):
    ref, _ = _inputs(spark, sf)
    return D.reference_shares(D.to_long(ref, [], CAT, "string"))


def _numeric(spark, sf):
    ref, cur = _inputs(spark, sf)
    return D.numeric_drift(D.to_long(ref, [], NUM), D.to_long(cur, G, NUM), G)


def _categorical(spark, sf):
    ref, cur = _inputs(spark, sf)
    return D.categorical_drift(D.to_long(ref, [], CAT, "string"), D.to_long(cur, G, CAT, "string"), G)


@register("drift_wasserstein", S.W1)
def q_w1(spark, sf):
    return _numeric(spark, sf).select(*G, "column", "wasserstein", "drift_score", "drifted")


@register("drift_ks", S.KS)
def q_ks(spark, sf):
    return _numeric(spark, sf).select(*G, "column", "ks")


@register("drift_psi", S.PSI)
def q_psi(spark, sf):
    ref, cur = _inputs(spark, sf)
    return D.psi(D.to_long(ref, [], NUM), D.to_long(cur, G, NUM), G)


@register("drift_js", S.JS)
def q_js(spark, sf):
    return _categorical(spark, sf).select(*G, "column", "jensen_shannon", "drifted")


@register("drift_chi2", S.CHI2)
def q_chi2(spark, sf):
    return _categorical(spark, sf).select(*G, "column", "chi2", F.col("chi2_df").cast("long").alias("chi2_df"))


@register("dataset_drift", S.DATASET_DRIFT)
def q_dataset_drift(spark, sf):
    ref, cur = _inputs(spark, sf)
    d = drift_table(ref, cur, EVENTS_SPEC)
    lab = cur.groupBy(*G).agg(F.count("y").alias("_n_lab"))
    agg = d.groupBy(*G).agg(F.sum(F.col("drifted").cast("int")).cast("int").alias("num_drifted_columns"))
    return agg.join(lab, G).select(
        *G, "num_drifted_columns",
        (F.col("num_drifted_columns") / (F.lit(3) + F.when(F.col("_n_lab") > 0, 1).otherwise(0)))
        .alias("share_drifted_columns"))


@register("prediction_drift", S.PRED_DRIFT)
def q_pred_drift(spark, sf):
    ref, cur = _inputs(spark, sf)
    d = D.numeric_drift(D.to_long(ref, [], ["p"]), D.to_long(cur, G, ["p"]), G)
    return d.select(*G, F.col("drift_score").alias("prediction_drift"))


@register("mean_score", S.MEAN_SCORE)
def q_mean_score(spark, sf):
    return current_batches(spark, sf).groupBy(*G).agg(F.avg("p").alias("mean_predicted_churn_prob"))


@register("drift_pvalues", S.PVALUES)
def q_drift_pvalues(spark, sf):
    """KS and chi-square p-values per batch and column (both chi-square tests)."""
    num, cat = D.with_pvalues(_numeric(spark, sf), _categorical(spark, sf))
    part = lambda df, test, stat, p: df.select(*G, "column", F.lit(test).alias("test"), F.col(stat).alias("statistic"), F.round(p, 9).alias("p_value"))
    return (part(num, "ks", "ks", "ks_pvalue").unionByName(part(cat, "chi2", "chi2", "chi2_pvalue"))
            .unionByName(part(cat, "homogeneity", "homogeneity", "homogeneity_pvalue")))


@register("drift_homogeneity", S.HOMOGENEITY)
def q_drift_homogeneity(spark, sf):
    """Two-sample chi-square of every batch against the reference."""
    return _categorical(spark, sf).select(*G, "column", "homogeneity", F.col("homogeneity_df").cast("long").alias("homogeneity_df"))


@register("drift_psi_deciles", S.PSI_DECILES)
def q_psi_deciles(spark, sf):
    """PSI on reference deciles."""
    ref, cur = _inputs(spark, sf)
    return D.psi(D.to_long(ref, [], NUM), D.to_long(cur, G, NUM), G, binning="quantile")
