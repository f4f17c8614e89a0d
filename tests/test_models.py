"""MLlib families, CV and scoring on the churn mart (small trees)."""

from pyspark.sql import functions as F

from tidemark.operators import model as M
from tidemark.plans import training as TR

from conftest import SF_SMALL


def test_cv_and_scoring(spark):
    spec, table, models = TR.cv_models(spark, SF_SMALL)
    assert len(models) == 10
    oof = M.out_of_fold(table, models)
    # every row is scored once per family, by the model that did not see it
    assert oof.count() == 2 * table.count()
    assert oof.filter((F.col("p") < 0) | (F.col("p") > 1)).count() == 0
    scored = M.fold_mean_score(table.drop("fold", "label"), models, keep=("id",))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # ten chained transforms, one narrow stage
    r = scored.agg(F.min("churn_probability"), F.max("churn_probability")).first()
    assert 0 <= r[0] <= r[1] <= 1
    m = TR.oof_metrics(oof).filter("metric = 'auc'").collect()
    assert len(m) == 10 and all(0 <= x["value"] <= 1 for x in m)


def test_search_draws_are_seeded():
    a = M.draw(42, "boost", 3)
    assert a == M.draw(42, "boost", 3) and a != M.draw(42, "boost", 4)
    assert 300 <= a["maxIter"] <= 2000 and 0.01 <= a["stepSize"] <= 0.3 and 0.4 <= float(a["featureSubsetStrategy"]) <= 1


def test_search_resumes_and_best_is_over_all_runs(spark, tmp_path):
    from tidemark.operators import registry as REG
    root = str(tmp_path / "reg")
    TR.search(spark, SF_SMALL, "forest", 1, root, space=M.SMALL_SPACE)
    trials = TR.search(spark, SF_SMALL, "forest", 1, root, space=M.SMALL_SPACE)
    assert sorted(r["number"] for r in trials.collect()) == [0, 1]
    best = REG.best_trial(trials).first()
    assert best["value"] == max(r["value"] for r in trials.collect())
