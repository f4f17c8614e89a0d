"""Models: two tree families on MLlib, fold-wise CV, fold-mean and ensemble
scoring, feature importance, seeded random search with a persistent trials
table.

Fits run on the cluster (MLlib trees are distributed); the ten fold fits of a
CV pass are independent jobs submitted from a small driver thread pool, as
``CrossValidator(parallelism=...)`` does.  Scoring chains the fitted
pipelines' ``transform``s and averages the positive-class probabilities in one
projection — no join, no shuffle.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Seed and fold count of the reference; family names.
SEED = 42
FAMILIES = ("boost", "forest")
DEFAULT_PARAMS = {
    "boost": {"maxIter": 10, "maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 1.0,
              "minInstancesPerNode": 1},
    "forest": {"numTrees": 10, "maxDepth": 4, "subsamplingRate": 1.0, "minInstancesPerNode": 1},
}


def estimator(family: str, params: dict | None, features_col: str = "features", label: str = "label"):
    p = dict(DEFAULT_PARAMS[family])
    p.update(params or {})
    if family == "boost":
        return GBTClassifier(featuresCol=features_col, labelCol=label, seed=SEED, **p)
    if family == "forest":
        return RandomForestClassifier(featuresCol=features_col, labelCol=label, seed=SEED, **p)
    raise ValueError(family)


def pipeline(family: str, features: Sequence[str], params: dict | None = None) -> Pipeline:
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[asm, estimator(family, params)])


def fit(df: DataFrame, family: str, features: Sequence[str], params: dict | None = None) -> PipelineModel:
    return pipeline(family, features, params).fit(df)


def positive_probability(model: PipelineModel, df: DataFrame, name: str = "p",
                         keep: Sequence[str] = ("id",)) -> DataFrame:
    """Score a table: ``(keep..., name)`` with the class-1 probability."""
    out = model.transform(df)
    return out.select(*keep, vector_to_array("probability")[1].alias(name))


def cv_fit(df: DataFrame, features: Sequence[str], families: Sequence[str] = FAMILIES,
           params: dict | None = None, k: int = 5, fold_col: str = "fold", parallelism: int = 4):
    """Fit every (family, fold) model on the other folds.

    Returns ``{(family, fold): PipelineModel}``.  The fold frame should be
    persisted by the caller (it is read by every fit).
    """
    jobs = [(f, i) for f in families for i in range(k)]

    def one(job):
        fam, i = job
        train = df.filter(F.col(fold_col) != i)
        return job, fit(train, fam, features, (params or {}).get(fam))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        return dict(ex.map(one, jobs))


def out_of_fold(df: DataFrame, models: dict, fold_col: str = "fold", keep=("id", "label")) -> DataFrame:
    """Held-out predictions ``(family, fold, keep..., p)`` of every fold model."""
    parts = []
    for (fam, i), m in sorted(models.items()):
        held = df.filter(F.col(fold_col) == i)
        s = m.transform(held).select(F.lit(fam).alias("family"), F.lit(i).alias("fold"), *keep,
                                     vector_to_array("probability")[1].alias("p"))
        parts.append(s)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mean_of(columns: Sequence[str]):
    """Equal-weight mean of score columns: folds of a family (M5), families of the ensemble (M6)."""
    return sum((F.col(c) for c in columns[1:]), F.col(columns[0])) / len(columns)


def fold_mean_score(df: DataFrame, models: dict, keep=("id",)) -> DataFrame:
    """Score with every fold model: per family the mean of its K fold
    probabilities (M5), and the equal-weight ensemble of family means (M6).

    The feature vector is assembled once; the tree stages are chained on one
    frame (each adds a probability column), then one projection averages.
    """
    ordered = sorted(models.items())
    first = ordered[0][1].stages[0]
    if any(m.stages[0].getInputCols() != first.getInputCols() for _, m in ordered):
        raise ValueError("the fold models were fitted on different feature lists")
    cur = first.transform(df)
    cols = {}
    for (fam, i), m in ordered:
        name = f"_p_{fam}_{i}"
        cur = m.stages[-1].transform(cur).withColumn(name, vector_to_array("probability")[1]) \
               .drop("rawPrediction", "probability", "prediction")
        cols.setdefault(fam, []).append(name)
    out = cur.select(*keep, *[mean_of(cs).alias(f"p_{f}") for f, cs in cols.items()])
    return out.withColumn("churn_probability", mean_of([f"p_{f}" for f in cols]))


def top_importance(spark, models: dict, features: Sequence[str], n: int = 15) -> DataFrame:
    """Gain-based feature importances (normalised, as MLlib reports them) of every model, top n per model.
    Split counts: :func:`split_importance`."""
    rows = []
    for (fam, i), m in models.items():
        imp = m.stages[-1].featureImportances.toArray()
        rows += [(fam, int(i), f, float(v)) for f, v in zip(features, imp)]
    df = spark.createDataFrame(rows, "family string, fold int, feature string, importance double")
    from pyspark.sql import Window
    w = Window.partitionBy("family", "fold").orderBy(F.col("importance").desc(), "feature")
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


NODE_COLUMNS = "family string, fold int, tree int, node int, n_rows long, gain double, prediction double, left int, right int, feature int, threshold double"


def node_table(spark, models: dict, uri: str) -> DataFrame:
    """The nodes of all trees of the fold models saved under ``uri`` (``save_models``), read from their files.

    (family, fold, tree, node, n_rows, gain, prediction, left, right, feature, threshold);
    a leaf has no children (-1), no feature and no threshold.
    """
    out = spark.createDataFrame([], NODE_COLUMNS)
    for fam, i in sorted(models):
        t = spark.read.parquet(f"{uri}/{fam}_{i}/stages/1_*/data")
        n = F.col("nodeData")
        inner = n["leftChild"] >= 0
        out = out.unionByName(t.select(
            F.lit(fam).alias("family"), F.lit(int(i)).alias("fold"), F.col("treeID").alias("tree"), n["id"].alias("node"), n["rawCount"].alias("n_rows"),
            n["gain"].alias("gain"), n["prediction"].alias("prediction"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
            F.when(inner, n["split"]["featureIndex"]).alias("feature"),
            F.when(inner, F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold")))
    return out


def split_importance(nodes: DataFrame, features: Sequence[str], n: int | None = None) -> DataFrame:
    """(family, fold, feature, splits, rank): how often each feature splits a node; all features, or the top ``n`` of each model.

    Features that split nothing count 0; ties go by feature name.
    """
    from pyspark.sql import Window
    spark = nodes.sparkSession
    names = spark.createDataFrame([(i, f) for i, f in enumerate(features)], "feature int, name string")
    counts = nodes.filter("feature is not null").groupBy("family", "fold", "feature").agg(F.count(F.lit(1)).alias("splits"))
    grid = nodes.select("family", "fold").distinct().crossJoin(F.broadcast(names))  # models x features
    every = grid.join(counts, ["family", "fold", "feature"], "left").select("family", "fold", F.col("name").alias("feature"), F.coalesce("splits", F.lit(0)).alias("splits"))
    ranked = every.withColumn("rank", F.row_number().over(Window.partitionBy("family", "fold").orderBy(F.col("splits").desc(), "feature")))
    return ranked if n is None else ranked.filter(F.col("rank") <= n)


# ---------------------------------------------------------------- prefixes of an ensemble

def n_trees(model: PipelineModel) -> int:
    return len(model.stages[-1].treeWeights)


def first_trees(model: PipelineModel, k: int) -> PipelineModel:
    """The model made of the first ``k`` trees of a fitted one.

    Boosting adds trees one by one: this is the model that a fit of ``k`` trees
    with the same seed gives.  A forest's trees are independent draws, any ``k``
    of them a forest.  So one fit of the longest ensemble scores every shorter one.
    """
    from pyspark import SparkContext
    from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel

    stage = model.stages[-1]
    if not 0 < k <= n_trees(model):
        raise ValueError(f"{k} of {n_trees(model)} trees")
    sc = SparkContext._active_spark_context
    jvm, java, ml = sc._jvm, stage._java_obj, sc._jvm.org.apache.spark.ml
    boosted = isinstance(stage, GBTClassificationModel)
    kind = ml.regression.DecisionTreeRegressionModel if boosted else ml.classification.DecisionTreeClassificationModel
    trees = sc._gateway.new_array(kind, k)
    every = java.trees()
    for i in range(k):
        trees[i] = every[i]
    if boosted:
        weights = sc._gateway.new_array(jvm.double, k)
        for i, w in enumerate(java.treeWeights()[:k]):
            weights[i] = w
        made = GBTClassificationModel(ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses()))
    else:
        made = RandomForestClassificationModel(ml.classification.RandomForestClassificationModel(java.uid(), trees, java.numFeatures(), java.numClasses()))
    made._resetUid(stage.uid)
    for name in ("featuresCol", "predictionCol", "probabilityCol", "rawPredictionCol"):
        made._java_obj.set(made._java_obj.getParam(name), stage.getOrDefault(name))
    return PipelineModel([*model.stages[:-1], made])


# ---------------------------------------------------------------- artifacts

MANIFEST_SCHEMA = "family string, fold int, path string, params string, features array<string>"


def save_models(spark, models: dict, uri: str, features: Sequence[str], params: dict | None = None) -> None:
    """Save every fold model under ``uri`` (never over an existing one) with a
    manifest: path, parameters and the ordered feature list of each."""
    rows = []
    for (fam, i), m in sorted(models.items()):
        m.save(f"{uri}/{fam}_{i}")
        rows.append((fam, int(i), f"{uri}/{fam}_{i}", json.dumps({**DEFAULT_PARAMS[fam], **((params or {}).get(fam) or {})}, sort_keys=True), list(features)))
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.parquet(f"{uri}/manifest")


def load_models(spark, uri: str) -> tuple[dict, list[str]]:
    """({(family, fold): model}, feature list) from a manifest."""
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{uri}/manifest").collect()  # a row per fold model
    return {(r["family"], r["fold"]): PipelineModel.load(r["path"]) for r in rows}, list(rows[0]["features"])


# ---------------------------------------------------------------- search

# The reference's search ranges, for the parameters that MLlib
# has (trees, depth, step size, row and column sampling, leaf size, minimum
# gain).  Leaf counts and leaf penalties have no MLlib counterpart.
SPACE = {
    "boost": {"maxIter": ("int", 300, 2000), "maxDepth": ("int", 3, 10), "stepSize": ("log", 0.01, 0.3),
              "subsamplingRate": ("uniform", 0.5, 1.0), "featureSubsetStrategy": ("share", 0.4, 1.0),
              "minInstancesPerNode": ("int", 5, 50)},
    "forest": {"numTrees": ("int", 300, 2000), "maxDepth": ("int", 3, 10),
               "subsamplingRate": ("uniform", 0.5, 1.0), "featureSubsetStrategy": ("share", 0.4, 1.0),
               "minInfoGain": ("uniform", 0.0, 5.0)},
}
#: a cheap space for tests and small tables; pass it explicitly
SMALL_SPACE = {
    "boost": {"maxIter": ("int", 2, 5), "maxDepth": ("int", 2, 3), "stepSize": ("log", 0.01, 0.3),
              "featureSubsetStrategy": ("share", 0.4, 1.0)},
    "forest": {"numTrees": ("int", 3, 8), "maxDepth": ("int", 2, 4), "featureSubsetStrategy": ("share", 0.4, 1.0),
               "minInfoGain": ("uniform", 0.0, 0.01)},
}


def draw(seed, family: str, trial: int, space: dict | None = None) -> dict:
    """Seeded draws for one trial: int-uniform, uniform, log-uniform; a share is passed as text (MLlib's form)."""
    import hashlib
    import math
    out = {}
    for name, (kind, lo, hi) in sorted((space or SPACE[family]).items()):
        h = hashlib.md5(f"{seed}:{family}:{trial}:{name}".encode()).hexdigest()
        u = int(h[:8], 16) / 4294967296
        if kind == "int":
            out[name] = int(lo + math.floor(u * (hi - lo + 1)))
        elif kind == "log":
            out[name] = float(math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo))))
        elif kind == "share":
            out[name] = str(round(lo + u * (hi - lo), 6))
        else:
            out[name] = float(lo + u * (hi - lo))
    return out
