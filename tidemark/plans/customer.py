"""End-to-end jobs on the customer-record format (header CSV with id,
gender, 18 inputs and Churn; JSON record batches for scoring).

``train`` runs load -> quarantine -> frozen features -> stratified folds ->
CV fits of both families -> out-of-fold metrics -> fold-mean scores of the
test table -> submission -> registry version and champion rule.  ``score``
runs validate -> features -> fold-mean ensemble -> rounded score and
decision.  Every step is a Spark job; the driver only submits fits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.columns import decide, lenient_double, round_score
from tidemark.operators import model as M
from tidemark.operators import registry as REG
from tidemark.operators import customer_record as SC
from tidemark.operators import split as SP
from tidemark.operators import validate as V
from tidemark.operators.evaluate import cv_summary
from tidemark.operators.materialize import materialize
from tidemark.plans.training import PREFIXES, best_params, by_fold, log_cv, oof_metrics, search_table
from tidemark.sources import sinks as K


# Fixed value: trials of a search for each family.
SEARCH_TRIALS = 5


def load_customers(spark: SparkSession, path: str, with_label: bool = True) -> DataFrame:
    """Header CSV with the explicit schema; blank or bad TotalCharges -> 0.0."""
    fields = [f for f in SC.TRAIN_CSV_SCHEMA.fields if with_label or f.name != "Churn"]
    df = K.read_csv(spark, path, StructType(fields))
    return df.withColumn("TotalCharges", lenient_double("TotalCharges"))


def train(spark: SparkSession, train_path: str, test_path: str, out_root: str,
          params: dict | None = None, k: int = 5, seed: int = 42, n_trials: int | None = None, space: dict | None = None,
          name: str = "churn", run_id: str | None = None) -> dict:
    """Load, search (``n_trials`` per family; the best stored trial feeds the
    fits), fit, log, save, register and promote by the rule.

    Without ``params`` the search makes ``SEARCH_TRIALS`` trials per family over
    the full space, each scored at prefixes of its ensembles; given parameters
    are used as they are.

    Every run saves its models under its own uri, so an older version keeps
    the files it was registered with.
    """
    run_id = run_id or uuid.uuid4().hex
    tr = load_customers(spark, train_path)
    te = load_customers(spark, test_path, with_label=False)
    checked = V.check(tr, SC.record_rules())
    valid = checked.filter("n_errors = 0").drop("errors", "n_errors", "warnings")
    quarantine = checked.filter("n_errors > 0").select("id", "errors")
    spec = SC.frozen_customer_spec()
    table = by_fold(SP.stratified_folds(spec.transform(valid), "label", k=k, seed=seed))
    registry = f"{out_root}/registry"
    n_trials = n_trials if n_trials is not None else 0 if params else SEARCH_TRIALS
    if n_trials:
        for family in M.FAMILIES:
            trials = search_table(spark, spec, table, family, n_trials, registry, study=name, seed=seed, space=space, k=k, shares=PREFIXES)
        params = {**best_params(trials, name), **(params or {})}
    models = M.cv_fit(table, spec.columns, params=params, k=k)
    metrics = materialize(oof_metrics(M.out_of_fold(table, models)), "customer_fold_metrics")
    log_cv(spark, registry, run_id, spec, table, metrics, params, {"model": name})
    scores = M.fold_mean_score(spec.transform(te, with_target=False), models, keep=("id",))
    submission = f"{out_root}/submission"
    K.write_predictions(scores.select("id", F.col("churn_probability").alias("Churn")), submission,
                        score="Churn")
    uri = f"{out_root}/models/{run_id}"
    M.save_models(spark, models, uri, spec.columns, params)
    K.export_fold_metrics(metrics, f"{uri}/fold_metrics")
    fam_auc = (metrics.filter("metric = 'auc'").groupBy("family").agg(F.avg("value").alias("m"))
               .agg(F.avg("m")).first()[0])  # mean of the family mean AUCs
    version = REG.register_version(spark, registry, name, run_id, uri, fam_auc, "+".join(M.FAMILIES))
    promoted = REG.promote_if_better(spark, registry, name, version, fam_auc)
    return {"spec": spec, "models": models, "fold_metrics": metrics, "summary": cv_summary(metrics),
            "quarantine": quarantine, "submission": submission, "ensemble_auc": fam_auc, "run_id": run_id,
            "version": version, "promoted": promoted, "uri": uri, "params": params}


def load_champion(spark: SparkSession, out_root: str, name: str = "churn") -> tuple[dict, dict]:
    """(fold models of the champion, its information row) by alias -> version -> uri."""
    row = REG.champion(spark, f"{out_root}/registry", name).first()
    if row is None or row["uri"] is None:
        raise LookupError(f"no champion of {name}")
    models, features = M.load_models(spark, row["uri"])
    return models, {**row.asDict(), "features": features}


def score(records: DataFrame, models: dict, spec=None) -> tuple[DataFrame, DataFrame]:
    """(predictions ``id, churn_probability, churn``, quarantine) for records."""
    spec = spec or SC.frozen_customer_spec()
    valid, bad = V.split_valid(records, SC.record_rules(present=set(records.columns)))
    s = M.fold_mean_score(spec.transform(valid.drop("warnings"), with_target=False), models, keep=("id",))
    # the decision uses the unrounded score; the served score is rounded
    out = s.select("id", round_score("churn_probability").alias("churn_probability"),
                   (decide("churn_probability") == 1).alias("churn"))
    return out, bad.select("id", "errors")


RECORD_WITH_ID = StructType([SC.TRAIN_SCHEMA["id"]] + SC.RECORD_SCHEMA.fields)


def score_stream(spark: SparkSession, src: str, models: dict, out: str, quarantine: str, checkpoint: str,
                 once: bool = True, interval: str = "10 seconds", max_files_per_trigger: int | None = None):
    """JSON record files arrive in ``src``; every micro-batch is validated,
    scored and appended to ``out``; invalid records go to ``quarantine`` with
    their reasons instead of failing the batch.  Both tables are partitioned by
    micro-batch, so a replayed one replaces its own rows.  Restarting with the same
    checkpoint resumes after the last committed batch."""
    from tidemark.streaming import jobs as ST

    def per_batch(df, epoch):
        preds, bad = score(materialize(df, "micro-batch"), models)
        ST.write_epoch(preds, out, epoch)
        ST.write_epoch(bad, quarantine, epoch)

    stream = ST.file_stream(spark, src, RECORD_WITH_ID, fmt="json", max_files_per_trigger=max_files_per_trigger)
    return ST.run_foreach_batch(stream, per_batch, checkpoint, once=once, interval=interval)


NUMERICAL_FEATURES = [n for n, _ in SC.FIELDS if n not in SC.ENUMS]
CATEGORICAL_FEATURES = [n for n, _ in SC.FIELDS if n in SC.ENUMS]


def _scored(df: DataFrame, models: dict, spec, carry) -> DataFrame:
    """Score while carrying the raw columns (prefixed) through one narrow stage."""
    raw = df.select(*[F.col(f"`{c}`").alias("raw__" + c) for c in carry], *[F.col(f"`{c}`") for c in df.columns])
    feats = spec.transform(raw, keep=["raw__" + c for c in carry], with_target=False)
    s = M.fold_mean_score(feats, models, keep=["raw__" + c for c in carry])
    return s.select(*[F.col("raw__" + c).alias(c) for c in carry],
                    round_score("churn_probability").alias("churn_probability"))


def monitor(spark: SparkSession, train_path: str, test_path: str, models: dict, metrics_path: str,
            run_id: str, mode: str = "none", batch_size: int = 1000, reference_frac: float = 0.2,
            missing_rate: float = 0.0, seed: int = 42) -> DataFrame:
    """Replay the labelled holdout and the unlabelled test table in fixed-size
    batches against a stratified reference sample, as one grouped job.

    Optional drift injection (``mode``: sustained / gradual / cycle) shifts
    the inputs before scoring; cells are blanked after scoring; labels are
    untouched.  One metrics row per batch is appended to ``metrics_path``
    (partitioned by source, keyed by ``run_id``) and returned.
    """
    from tidemark.functions.columns import dict_map
    from tidemark.operators import perturb as X
    from tidemark.operators.features import BINARY_MAP, fit_categories
    from tidemark.plans.fixtures import with_batches
    from tidemark.plans.monitoring import MonitorSpec, batch_metrics

    spec = SC.frozen_customer_spec()
    tr = load_customers(spark, train_path).withColumn("label", dict_map("Churn", BINARY_MAP).cast("int"))
    te = load_customers(spark, test_path, with_label=False)
    split = SP.stratified_split(tr, "label", reference_frac, seed)
    ref = split.filter("split = 'reference'").drop("split")
    hold = split.filter("split = 'holdout'").drop("split")
    cur = with_batches(SP.pools(hold, te), size=batch_size)
    cur = X.global_batch_number(cur).withColumn("intensity", X.intensity("global_batch", mode))
    cur = materialize(cur, "customer_batches")
    inten = F.col("intensity")
    if mode != "none":
        stds = ref.agg(*[F.stddev_pop(c).alias(c) for c in NUMERICAL_FEATURES if c != "SeniorCitizen"]).first()
        for c in ("tenure", "MonthlyCharges", "TotalCharges"):
            std = float(stds[c] or 0.0) or 1.0
            cur = cur.withColumn(c, X.shift_numeric(c, std, inten, integral=(c == "tenure")))
        cur = cur.withColumn("SeniorCitizen", X.flip_binary("SeniorCitizen", inten))
        cats = fit_categories(ref, CATEGORICAL_FEATURES)
        for c in CATEGORICAL_FEATURES:
            cur = cur.withColumn(c, X.swap_category(c, cats[c], inten))
    carry = ["id", "label"] + NUMERICAL_FEATURES + CATEGORICAL_FEATURES
    ref_s = _scored(ref, models, spec, carry)
    cur_s = _scored(cur, models, spec, carry + ["data_source", "batch_id", "intensity"])
    if mode != "none" and missing_rate > 0:
        for c in NUMERICAL_FEATURES + CATEGORICAL_FEATURES:
            cur_s = cur_s.withColumn(c, X.blank_cells(c, inten, missing_rate))
    cur_s = materialize(cur_s, "customer_scored")
    mspec = MonitorSpec(numeric=tuple(NUMERICAL_FEATURES), categorical=tuple(CATEGORICAL_FEATURES),
                        prediction="churn_probability", target="label", ts=None, intensity="intensity", bounded=True)
    m = batch_metrics(ref_s, cur_s, mspec)
    K.append_metrics(m, metrics_path, run_id)
    return spark.read.parquet(metrics_path).filter(F.col("run_id") == run_id)
