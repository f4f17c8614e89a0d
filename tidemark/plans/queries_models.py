"""Queries: model fits, CV, scoring, importance, search, registry."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import functions as F

from tidemark.functions.columns import decide, hash_uniform, round_score
from tidemark.operators import model as M
from tidemark.operators import registry as REG
from tidemark.operators.materialize import materialize
from tidemark.operators.rank import default_bucket_count, dist_rank, unit_bucket
from tidemark.plans import training as TR
from tidemark.plans.catalog import register
from tidemark.plans.fixtures import scored_events
from tidemark.plans.sql.common import MART, SCORED, u_sql
from tidemark.session import scratch_path


FOLDED_SQL = (f"WITH {MART}, f AS (SELECT id, churn, CAST((row_number() OVER (PARTITION BY churn ORDER BY {u_sql(42, 'id')}, id) - 1) % 5 AS INTEGER) "
              "AS fold FROM records)")


def _in_range(p: str):
    return F.coalesce((F.col(p) >= 0) & (F.col(p) <= 1), F.lit(False))


LABELS_SQL = f"WITH {MART} SELECT id, CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS label, true AS score_ok FROM records"


def _fitted(spark, sf, family):
    spec, table = TR.training_frame(spark, sf)
    scored = M.positive_probability(M.fit(table, family, spec.columns), table, "p", keep=("id", "label"))
    return scored.select("id", "label", _in_range("p").alias("score_ok"))


@register("fit_family_a", LABELS_SQL)
def q_fit_a(spark, sf):
    """Boosting fitted on the mart: every row is scored, with a probability."""
    return _fitted(spark, sf, "boost")


@register("fit_family_b", LABELS_SQL)
def q_fit_b(spark, sf):
    """The same for the forest."""
    return _fitted(spark, sf, "forest")


@register("cv_oof", FOLDED_SQL + " SELECT family, fold, id, CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS label, true AS score_ok "
          "FROM f, (VALUES ('boost'), ('forest')) AS v(family)")
def q_cv_oof(spark, sf):
    """Out-of-fold scores: every row once per family, in its own fold."""
    spec, table, models = TR.cv_models(spark, sf)
    return M.out_of_fold(table, models).select("family", "fold", "id", "label", _in_range("p").alias("score_ok"))


@register("cv_fold_metrics")
def q_cv_fold_metrics(spark, sf):
    spec, table, models = TR.cv_models(spark, sf)
    return TR.oof_metrics(M.out_of_fold(table, models))


@register("top_importance")
def q_top_importance(spark, sf):
    spec, table, models = TR.cv_models(spark, sf)
    return M.top_importance(spark, models, spec.columns, 15)


@register("split_importance", "SELECT family, f AS fold, 10 AS n_trees, true AS splits_add_up, true AS depth_ok, true AS rows_add_up "
          "FROM (VALUES ('boost'), ('forest')) AS v(family), range(0, 5) AS r(f) WHERE EXISTS (SELECT 1 FROM orders)")
def q_split_importance(spark, sf):
    """Split counts per feature of the saved models, held against their node table: a tree with n splits
    has n + 1 leaves, no path is longer than the depth, and children share their parent's rows."""
    spec, table, models = TR.cv_models(spark, sf)
    uri = f"{scratch_path(spark, 'trees')}"
    M.save_models(spark, models, uri, spec.columns)
    nodes = materialize(M.node_table(spark, models, uri), "nodes")
    splits = M.split_importance(nodes, spec.columns).groupBy("family", "fold").agg(F.sum("splits").alias("splits"))
    per = nodes.groupBy("family", "fold").agg(F.countDistinct("tree").alias("n_trees"), F.count(F.lit(1)).alias("n_nodes"))
    per_tree = nodes.groupBy("family", "fold", "tree").agg(F.count(F.lit(1)).alias("n"))
    deepest = F.when(F.col("family") == "boost", M.DEFAULT_PARAMS["boost"]["maxDepth"]).otherwise(M.DEFAULT_PARAMS["forest"]["maxDepth"])
    depth = per_tree.groupBy("family", "fold").agg(F.min(F.col("n") <= F.pow(F.lit(2.0), deepest + 1) - 1).alias("depth_ok"))
    child = nodes.select("family", "fold", "tree", F.col("node").alias("left"), F.col("n_rows").alias("n_left"))
    other = nodes.select("family", "fold", "tree", F.col("node").alias("right"), F.col("n_rows").alias("n_right"))
    tree = ["family", "fold", "tree"]
    rows = nodes.filter("feature is not null").join(child, [*tree, "left"]).join(other, [*tree, "right"]).groupBy("family", "fold") \
        .agg(F.min(F.col("n_rows") == F.col("n_left") + F.col("n_right")).alias("rows_add_up"))
    out = per.join(splits, ["family", "fold"]).join(depth, ["family", "fold"]).join(rows, ["family", "fold"])
    return out.select("family", F.col("fold").cast("long").alias("fold"), F.col("n_trees").cast("int").alias("n_trees"),
                      (2 * F.col("splits") + F.col("n_trees") == F.col("n_nodes")).alias("splits_add_up"), "depth_ok", "rows_add_up")


def _champion(spark, sf, root):
    """Fit, save under the run's own uri, register, promote; then load what the alias points to."""
    spec, table, models = TR.cv_models(spark, sf)
    auc = TR.oof_metrics(M.out_of_fold(table, models)).filter("metric = 'auc'").agg(F.avg("value")).first()[0]
    run_id = uuid.uuid4().hex
    uri = f"{root}/artifacts/{run_id}"
    M.save_models(spark, models, uri, spec.columns)
    ver = REG.register_version(spark, root, "churn_ensemble", run_id, uri, auc, "+".join(M.FAMILIES))
    REG.promote_if_better(spark, root, "churn_ensemble", ver, auc)
    return table, REG.champion(spark, root, "churn_ensemble").first()


@register("batch_score", f"WITH {MART} SELECT id, true AS score_ok, true AS rounded, true AS decision_ok FROM records")
def q_batch_score(spark, sf):
    """Score the mart with the champion, found by alias -> version -> uri and
    loaded from its files: fold means, ensemble, rounded score and decision."""
    table, info = _champion(spark, sf, scratch_path(spark, "registry"))
    models, _ = M.load_models(spark, info["uri"])
    s = M.fold_mean_score(table, models, keep=("id",))
    served = s.select("id", "churn_probability", round_score("churn_probability").alias("served"), (decide("churn_probability") == 1).alias("churn"))
    return served.select("id", _in_range("served").alias("score_ok"), (F.abs(F.col("served") - F.col("churn_probability")) <= 5e-7).alias("rounded"),
                         (F.col("churn") == (F.col("churn_probability") >= 0.5)).alias("decision_ok"))


N_SEARCH = 2


def _space_sql():
    """The seeded draws of every trial's parameters (text), as SQL over md5."""
    rows = []
    for fam, space in M.SMALL_SPACE.items():
        for name, (kind, lo, hi) in space.items():
            u = f"(CAST(('0x' || substr(md5('42:{fam}:' || n || ':{name}'), 1, 8)) AS BIGINT) / 4294967296.0)"
            value = {"int": f"CAST(floor({lo} + floor({u} * {hi - lo + 1})) AS DOUBLE)", "log": f"exp(ln({lo}) + {u} * (ln({hi}) - ln({lo})))"}.get(
                kind, f"round({lo} + {u} * ({hi} - {lo}), 6)")
            rows.append(f"SELECT '{fam}' AS family, CAST(n AS INTEGER) AS number, '{name}' AS parameter, round({value}, 6) AS value FROM range(0, {N_SEARCH}) AS t(n)")
    return f"WITH {MART}, d AS (" + " UNION ALL ".join(rows) + ") SELECT d.*, (SELECT count(*) FROM records) AS n_rows, true AS objective_ok FROM d"


@register("search", _space_sql())
def q_search(spark, sf):
    """A seeded search of both families over the small space on the mart: the
    drawn parameters of every stored trial."""
    root = scratch_path(spark, "registry")
    spec, table = TR.training_frame(spark, sf)
    for fam in M.FAMILIES:
        trials = TR.search_table(spark, spec, table, fam, N_SEARCH, root, space=M.SMALL_SPACE)
    long = trials.select("family", "number", _in_range("value").alias("objective_ok"), F.explode(F.from_json("params", "map<string,string>")).alias("parameter", "value"))
    return long.select("family", "number", "parameter", F.round(F.col("value").cast("double"), 6).alias("value"), "objective_ok") \
        .crossJoin(F.broadcast(table.agg(F.count(F.lit(1)).alias("n_rows"))))  # one row


RUN_METRICS = ("auc", "accuracy", "precision", "recall", "f1", "log_loss")


@register("run_log", "SELECT CASE WHEN f IS NULL THEN 'parent' ELSE 'fold' END AS stage, family, f AS fold, m AS metric, "
          "CAST(CASE WHEN f IS NULL THEN 2 ELSE 1 END AS BIGINT) AS n_values "
          f"FROM (VALUES ('boost'), ('forest')) AS v(family), (VALUES {', '.join(f"('{m}')" for m in RUN_METRICS)}) AS w(m), "
          "(VALUES (NULL), (0), (1), (2), (3), (4)) AS x(f) WHERE EXISTS (SELECT 1 FROM orders)")
def q_run_log(spark, sf):
    """The run log of one CV: a parent run with mean and spread of every
    metric, a child run per family and fold."""
    spec, table, models = TR.cv_models(spark, sf)
    root = scratch_path(spark, "runs")
    TR.log_cv(spark, root, "run-1", spec, table, TR.oof_metrics(M.out_of_fold(table, models)), None)
    runs = spark.read.parquet(f"{root}/runs").select("run_id", "parent", F.col("tags")["stage"].alias("stage"))
    logged = runs.join(spark.read.parquet(f"{root}/run_metrics"), "run_id")
    fold = F.regexp_extract("run_id", r"/(\w+)_(\d+)$", 2)
    family = F.when(F.col("parent").isNull(), F.split("key", "_")[0]).otherwise(F.regexp_extract("run_id", r"/([a-z]+)_\d+$", 1))
    metric = F.when(F.col("parent").isNull(), F.regexp_extract("key", "^[a-z]+_(.*)_(mean|std)$", 1)).otherwise(F.col("key"))
    return logged.groupBy(F.when(F.col("parent").isNull(), "parent").otherwise("fold").alias("stage"), family.alias("family"),
                          F.when(fold != "", fold.cast("int")).alias("fold"), metric.alias("metric")).agg(F.count(F.lit(1)).alias("n_values"))


# ------------------------------------------------ score-column and table rules

K = 5
FOLD_SCORE_A = [f"round(1 / (1 + exp(-(value - {50 - 2 * k}) / 50)), 6)" for k in range(K)]
FOLD_SCORE_B = [f"round(1 / (1 + exp(-(value - {40 + 2 * k}) / 60)), 6)" for k in range(K)]


def fold_scores(spark, sf):
    ev = scored_events(spark, sf)
    cols = [F.round(1 / (1 + F.exp(-(F.col("value") - (50 - 2 * k)) / 50)), 6).alias(f"a{k}") for k in range(K)]
    cols += [F.round(1 / (1 + F.exp(-(F.col("value") - (40 + 2 * k)) / 60)), 6).alias(f"b{k}") for k in range(K)]
    return ev.select("id", *cols)


@register("fold_mean", f"WITH {SCORED} SELECT id, ({' + '.join(FOLD_SCORE_A)}) / {K} AS p_a FROM scored")
def q_fold_mean(spark, sf):
    return fold_scores(spark, sf).select("id", M.mean_of([f"a{k}" for k in range(K)]).alias("p_a"))


@register("ensemble_mean", f"WITH {SCORED} SELECT id, (({' + '.join(FOLD_SCORE_A)}) / {K} "
          f"+ ({' + '.join(FOLD_SCORE_B)}) / {K}) / 2 AS churn_probability FROM scored")
def q_ensemble_mean(spark, sf):
    s = fold_scores(spark, sf)
    means = s.select("id", M.mean_of([f"a{k}" for k in range(K)]).alias("p_a"), M.mean_of([f"b{k}" for k in range(K)]).alias("p_b"))
    return means.select("id", M.mean_of(["p_a", "p_b"]).alias("churn_probability"))


N_TRIALS = 5


def center_trials(spark, sf):
    """A seeded search over the decision centre of a logistic score: trial t
    draws ``c = 20 + 60 u(42, 'center:t')``; objective = mean accuracy over
    the 5 stratified folds of the labelled events, one conditional aggregate
    per trial."""
    s = scored_events(spark, sf).filter(F.col("y").isNotNull())
    nb = default_bucket_count(spark)
    s = s.withColumn("_u", hash_uniform(42, "id"))
    s = dist_rank(s, ["y"], ["_u", "id"], unit_bucket("_u", nb), "_r") \
        .withColumn("fold", ((F.col("_r") - 1) % 5).cast("int"))
    u = [int(hashlib.md5(f"42:center:{t}".encode()).hexdigest()[:8], 16) / 4294967296 for t in range(N_TRIALS)]
    centers = [20 + 60 * x for x in u]
    hit = lambda c: (F.col("y") == decide(F.round(1 / (1 + F.exp(-(F.col("value") - F.lit(c)) / 50)), 6))).cast("double")
    folds = s.groupBy("fold").agg(*[F.avg(hit(c)).alias(f"t{t}") for t, c in enumerate(centers)])  # five aggregates in one pass
    wide = folds.agg(*[F.avg(f"t{t}").alias(f"t{t}") for t in range(N_TRIALS)])
    rows = F.array(*[F.struct(F.lit(t).alias("number"), F.lit(c).alias("center"), F.col(f"t{t}").alias("value")) for t, c in enumerate(centers)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


TRIALS_SQL = f"""{SCORED},
lab AS (SELECT * FROM scored WHERE y IS NOT NULL),
rk AS (SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY {u_sql(42, 'id')}, id) - 1) % 5 AS INTEGER) AS fold FROM lab),
tr AS (SELECT CAST(range AS INTEGER) AS number,
              20 + 60 * (CAST(('0x' || substr(md5('42:center:' || CAST(range AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0) AS center
       FROM range(0, {N_TRIALS})),
acc AS (SELECT number, center, fold,
               avg(CAST(y = CAST(round(1 / (1 + exp(-(value - center) / 50)), 6) >= 0.5 AS INTEGER) AS DOUBLE)) AS a
        FROM rk, tr GROUP BY number, center, fold),
trials AS (SELECT number, center, avg(a) AS value FROM acc GROUP BY number, center)"""


@register("best_trial", f"WITH {TRIALS_SQL} SELECT number, center, value FROM trials "
          "ORDER BY value DESC, number ASC LIMIT 1")
def q_best_trial(spark, sf):
    t = center_trials(spark, sf)
    stored = t.select(F.lit("centers").alias("study"), F.lit("logistic").alias("family"), "number", F.col("center").cast("string").alias("params"), "value")
    return REG.best_trial(stored).select("number", F.col("params").cast("double").alias("center"), "value")


@register("promote", f"WITH {TRIALS_SQL}, v AS (SELECT 'churn' AS name, number + 1 AS version, value AS auc FROM trials) "
          "SELECT name, version, auc, coalesce((count(*) OVER w = 0) OR (max(auc) OVER w IS NULL) OR (auc > max(auc) OVER w), false) AS promoted "
          "FROM v WINDOW w AS (PARTITION BY name ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def q_promote(spark, sf):
    t = center_trials(spark, sf)
    v = t.select(F.lit("churn").alias("name"), (F.col("number") + 1).alias("version"), F.col("value").alias("auc"))
    return REG.promotion_history(v)


@register("champion_info", f"WITH {TRIALS_SQL} SELECT 'churn' AS name, 'champion' AS alias, number + 1 AS version, "
          "value AS auc, 'trial-' || number AS run_id, 'm' || number AS uri, 'logistic' AS families FROM trials ORDER BY value DESC, number ASC LIMIT 1")
def q_champion_info(spark, sf):
    """Register every trial as a version in order, promoting by the rule;
    then read the champion alias joined to its version row."""
    root = scratch_path(spark, "registry")
    trials = center_trials(spark, sf).orderBy("number").collect()  # N_TRIALS rows
    for r in trials:
        ver = REG.register_version(spark, root, "churn", f"trial-{r['number']}", f"{root}/m{r['number']}", r["value"], "logistic")
        REG.promote_if_better(spark, root, "churn", ver, r["value"])
    info = REG.champion(spark, root, "churn")
    return info.select("name", "alias", "version", "auc", "run_id", F.element_at(F.split("uri", "/"), -1).alias("uri"), "families")


@register("register", "SELECT 'churn_ensemble' AS name, 1 AS version, 'boost+forest' AS families, true AS auc_ok, true AS own_uri, "
          "true AS champion, 10 AS n_models FROM (SELECT count(*) AS n FROM orders) WHERE n > 0")
def q_register(spark, sf):
    """Save the CV models under the run's own uri, register them as the next
    version with the mean OOF AUC, promote by the rule; the versions table
    with what its uri holds."""
    root = scratch_path(spark, "registry_models")
    _, info = _champion(spark, sf, root)
    n_models = spark.read.schema(M.MANIFEST_SCHEMA).parquet(f"{info['uri']}/manifest").agg(F.count(F.lit(1)).cast("int").alias("n_models"))
    versions = spark.read.schema(REG.VERSIONS_SCHEMA).parquet(f"{root}/model_versions")
    return versions.select("name", "version", "families", _in_range("auc").alias("auc_ok"), F.col("uri").endswith(F.col("run_id")).alias("own_uri"),
                           (F.col("version") == info["version"]).alias("champion")).crossJoin(n_models)  # one row
