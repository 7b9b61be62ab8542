"""Forests of all parts in shared passes: Spark's trees, and boosting whose rows are held as cells of joint tables."""

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from campanula.operators import boosting as BO
from campanula.operators import evaluate as EV
from campanula.operators import forest as FO
from campanula.operators import ml as M


def _frame(spark, n=1500):
    rng = np.random.default_rng(4)
    c, d = rng.integers(0, 5, n), rng.integers(0, 2, n)
    x, z = rng.normal(size=n).round(2), rng.integers(0, 90, n)
    y = rng.random(n) < 1 / (1 + np.exp(-1.5 * x - (c == 2) * 2 + (z > 40) + d))
    return spark.createDataFrame([(i, float(y[i]), float(x[i]), float(z[i]), "abcde"[c[i]], "uv"[d[i]]) for i in range(n)],
                                 "id long, label double, x double, z double, c string, d string")


@pytest.fixture(scope="module")
def rows(spark):
    df = _frame(spark)
    feats = Pipeline(stages=M.feature_stages(["x", "z"], ["c", "d"])).fit(df)
    slots = [1, 1] + [len(s.labels) - 1 for s in feats.stages if isinstance(s, StringIndexerModel)]
    return feats.transform(df).withColumn("weight", M.balanced_weight(df)).cache(), slots


def _scores(model, rows):
    return np.array([r[0] for r in model.transform(rows).orderBy("id").select(vector_to_array("probability")[1]).collect()])


def test_a_tree_of_all_rows_and_slots_is_sparks(rows):
    """Splits, class weights and pruning, over more levels than one lookup walks."""
    df, slots = rows
    for depth in (3, 6):
        plain = RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy="all", weightCol="weight", maxDepth=depth, seed=1)
        got = FO.fit_parts({0: df, 1: df.filter("id % 3 > 0")}, plain, slots)
        assert np.allclose(_scores(got[0], df), _scores(plain.fit(df), df), atol=1e-12)
        assert np.allclose(_scores(got[1], df), _scores(plain.fit(df.filter("id % 3 > 0")), df), atol=1e-12)


def test_many_rows_take_the_shared_forest(rows):
    """Over ``few`` rows a part no Spark forest is fitted; 40 drawn trees score as Spark's 40 do."""
    df, slots = rows
    rf = RandomForestClassifier(numTrees=40, weightCol="weight", seed=1)
    parts = {-1: df, 0: df.filter("id % 2 = 0")}
    got = M._fit_all({"rf": rf}, parts, slots, few=100)
    assert all(isinstance(m, FO.ForestModel) for m in got.values())
    trees = json.loads(got["rf", -1].getOrDefault("trees"))
    assert len(trees) == 40 and len({str(t) for t in trees}) > 30
    mine, spark_s = _scores(got["rf", -1], df), _scores(rf.copy().fit(df), df)
    assert np.corrcoef(mine, spark_s)[0, 1] > 0.98 and abs(mine.mean() - spark_s.mean()) < 0.02
    again = _scores(FO.fit_parts({-1: df}, rf, slots)[-1], df)
    assert (mine == again).all()  # drawn by the block's seed, not by chance
    assert not isinstance(M._fit_all({"rf": rf}, {-1: df}, slots)["rf", -1], FO.ForestModel)


def test_draws_are_poisson():
    n = 200_001
    a, b = (FO._draws(n, 42, t, (0, 0)) for t in (0, 1))
    assert len(a) == n and abs(a.mean() - 1) < 0.01 and abs(a.var() - 1) < 0.02 and abs((a == 0).mean() - np.exp(-1)) < 0.005
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01 and (a == FO._draws(n, 42, 0, (0, 0))).all()
    assert abs(np.corrcoef(a, FO._draws(n, 42, 0, (0, 1)))[0, 1]) < 0.01


def test_other_forests_keep_their_own_fit():
    assert FO.takes(M.classifiers()["Random Forest"])
    assert not any(FO.takes(e) for e in (RandomForestClassifier(impurity="entropy"), RandomForestClassifier(subsamplingRate=0.5),
                                         RandomForestClassifier(featureSubsetStrategy="log2"), LogisticRegression()))


def test_selected_forest_is_stored(spark, monkeypatch):
    real = M._fit_all
    monkeypatch.setattr(M, "_fit_all", lambda *a: real(*a, few=100))
    df = _frame(spark, 600)
    chosen = M.select_model(df, ["x", "z"], ["c", "d"], "id", {"rf": RandomForestClassifier(numTrees=10, weightCol="weight", seed=1)}, folds=2)
    assert isinstance(chosen.model.stages[-1], FO.ForestModel) and chosen.table.first().cv_auc > 0.65
    held = M.score_selected(chosen, df).filter("holdout")
    assert EV.auc(held, "label", "predicted_prob").first().auc == pytest.approx(chosen.table.first().auc_test, abs=1e-12)


def test_rows_are_ranked_once(spark, monkeypatch):
    """The holdout and the folds come from one written hash order."""
    ranked, rank = [], M.stratified_rank
    monkeypatch.setattr(M, "stratified_rank", lambda *a: (ranked.append(1), rank(*a))[1])
    M.select_model(_frame(spark, 300), ["x"], ["d"], "id", {"lr": LogisticRegression(maxIter=5, weightCol="weight")}, folds=2)
    assert len(ranked) == 1


def test_deep_boosting_is_sparks(rows):
    """Lookups beyond the first four levels, and margins written every other round."""
    df, slots = rows
    gbt = GBTClassifier(maxIter=5, maxDepth=5, stepSize=0.1, seed=1)
    assert np.allclose(_scores(BO.fit_parts({0: df}, gbt, slots)[0], df), _scores(gbt.fit(df), df), atol=1e-9)


def test_nodes_are_those_of_single_comparisons():
    rng = np.random.default_rng(1)
    widths = [32, 40, 7, 300, 2]
    codes = [rng.integers(0, w, 500) for w in widths]
    cells = [BO._cell(widths, columns, codes) for columns in BO._bundles(widths)]
    for depth in (1, 3, 5, 8):
        tree = [None if rng.random() < 0.2 else ((c := int(rng.integers(5))), int(rng.integers(widths[c])), bool(rng.integers(2))) for _ in range(2 ** depth - 1)]
        want = np.zeros(500, int)
        for d in range(depth):
            for r in range(500):
                t = tree[2 ** d - 1 + want[r]]
                want[r] = 2 * want[r] + (0 if t is None else codes[t[0]][r] == t[1] if t[2] else codes[t[0]][r] > t[1])
        assert (BO._nodes(cells, BO._tables(tree, widths, depth), depth) == want).all()


def test_missing_numbers_go_right():
    score = BO._Scorer([{"weight": 2.0, "slot": [1, -1, 0], "above": [0.5, 0.0, 3.0], "leaf": [1.0, 9.0, 4.0, 8.0]}])
    assert score(np.array([[0.0, 5, 5, np.nan], [0.5, 0.6, np.nan, 0.0]])).tolist() == [2.0, 16.0, 16.0, 2.0]
