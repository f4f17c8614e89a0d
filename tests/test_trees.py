"""Node tables of saved models, split counts, prefixes of ensembles."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import model as M
from tidemark.plans import training as TR

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def fitted(spark):
    spec, table, models = TR.cv_models(spark, SF_SMALL)
    return spec, table, models


def test_split_counts_follow_the_trees(spark, fitted, tmp_path):
    spec, _, models = fitted
    uri = str(tmp_path / "models")
    M.save_models(spark, models, uri, spec.columns)
    nodes = M.node_table(spark, models, uri)
    got = {(r.family, r.fold, r.feature): r.splits for r in M.split_importance(nodes, spec.columns).collect()}
    for (fam, fold), m in models.items():
        want = Counter()
        for tree in m.stages[-1].trees:
            for line in tree.toDebugString.splitlines():
                if "If (feature " in line:  # one line for each inner node
                    want[int(line.split("feature ")[1].split()[0])] += 1
        for i, name in enumerate(spec.columns):
            assert got[fam, fold, name] == want[i], (fam, fold, name)
    top = M.split_importance(nodes, spec.columns, 3)
    assert top.count() == 30 and top.filter("rank > 3").count() == 0
    leaf = nodes.filter("feature is null")
    assert leaf.filter("threshold is not null or left >= 0 or right >= 0").count() == 0


def test_prefix_of_boosting_is_the_shorter_fit(spark, fitted):
    spec, table, models = fitted
    train = table.filter("fold <> 0")
    long = M.fit(train, "boost", spec.columns, {"maxIter": 6})
    for k in (1, 4):
        short = M.fit(train, "boost", spec.columns, {"maxIter": k})
        a = {r.id: r.p for r in M.positive_probability(M.first_trees(long, k), table).collect()}
        b = {r.id: r.p for r in M.positive_probability(short, table).collect()}
        assert a.keys() == b.keys() and all(v == pytest.approx(b[i], abs=1e-12) for i, v in a.items())
    with pytest.raises(ValueError):
        M.first_trees(long, 7)


def test_prefix_of_a_forest_is_the_mean_of_its_first_trees(spark, fitted):
    spec, table, models = fitted
    m = models["forest", 0]
    cut = M.first_trees(m, 2)
    assert M.n_trees(cut) == 2 and M.n_trees(m) == 10
    x = m.stages[0].transform(table.limit(20)).collect()
    for r in x:
        votes = [t.predictProbability(r.features) for t in m.stages[-1].trees[:2]]
        assert cut.stages[-1].predictProbability(r.features)[1] == pytest.approx(sum(v[1] for v in votes) / 2)


def test_search_keeps_the_best_prefix(spark, fitted, tmp_path):
    import json
    spec, table, _ = fitted
    trials = TR.search_table(spark, spec, table, "boost", 1, str(tmp_path), space=M.SMALL_SPACE, k=2, shares=(0.5, 1.0)).collect()
    drawn = M.draw(42, "boost", 0, M.SMALL_SPACE["boost"])
    kept = json.loads(trials[0].params)
    assert kept["maxIter"] in {max(1, round(drawn["maxIter"] / 2)), drawn["maxIter"]} and 0 <= trials[0].value <= 1
