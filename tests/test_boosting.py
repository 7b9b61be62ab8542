"""Boosting of all parts in shared passes: the trees of a GBTClassifier, stored and read back with the selected model."""

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from campanula.operators import boosting as BO
from campanula.operators import ml as M


def _frame(spark, n=600):
    rng = np.random.default_rng(4)
    c, d = rng.integers(0, 5, n), rng.integers(0, 2, n)
    x, z = rng.normal(size=n).round(2), rng.integers(0, 90, n)
    y = rng.random(n) < 1 / (1 + np.exp(-1.5 * x - (c == 2) * 2 + (z > 40) + d))
    rows = [(i, float(y[i]), float(x[i]), float(z[i]), "abcde"[c[i]], "uv"[d[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, label double, x double, z double, c string, d string")


def test_all_parts_grow_in_the_same_passes(spark, monkeypatch):
    df = _frame(spark)
    feats = Pipeline(stages=M.feature_stages(["x", "z"], ["c", "d"])).fit(df)
    rows = feats.transform(df).withColumn("weight", F.lit(1.0))
    slots = [1, 1] + [len(s.labels) - 1 for s in feats.stages if isinstance(s, StringIndexerModel)]
    parts = {p: rows.filter(F.col("id") % 3 != p) for p in (-1, 0, 1)}
    gbt = GBTClassifier(maxIter=4, stepSize=0.05, maxDepth=3, seed=1)
    passes, sums = [], BO._level_sums
    monkeypatch.setattr(BO, "_level_sums", lambda b, w, *a: (passes.append(sorted(w)), sums(b, w, *a))[1])
    monkeypatch.setattr(BO, "REFRESH", 2)
    got = M._fit_all({"gbt": gbt}, parts, slots)
    assert passes == [[-1, 0, 1]] * 12  # rounds x levels, whatever the number of parts
    plain = BO.fit_parts({0: parts[0]}, gbt)  # every slot a number

    def scores(m):
        return np.array([r[0] for r in m.transform(rows).orderBy("id").select(vector_to_array("probability")[1]).collect()])
    assert np.allclose(scores(got["gbt", 0]), scores(plain[0]))
    for p in parts:
        assert np.allclose(scores(got["gbt", p]), scores(gbt.copy().fit(parts[p])), atol=1e-9)


def test_selected_boosting_is_stored(spark):
    df = _frame(spark)
    models = {"gbt": GBTClassifier(maxIter=3, maxDepth=2, seed=1)}
    chosen = M.select_model(df, ["x", "z"], ["c", "d"], "id", models, folds=2)
    assert isinstance(chosen.model.stages[-1], BO.BoostedModel) and chosen.table.first().cv_auc > 0.65
    held = M.score_selected(chosen, df).filter("holdout")
    assert M.EV.auc(held, "label", "predicted_prob").first().auc == chosen.table.first().auc_test


def test_other_settings_keep_their_own_fit():
    assert BO.takes(GBTClassifier(maxIter=3))
    assert not any(BO.takes(e) for e in (GBTClassifier(subsamplingRate=0.5), GBTClassifier(weightCol="weight"), LogisticRegression()))


def test_thresholds():
    assert BO.thresholds(np.array([1.0, 1, 4, 2]), 31).tolist() == [1.5, 3.0]
    assert BO.thresholds(np.zeros(3), 31).tolist() == []
    assert len(BO.thresholds(np.arange(1000.0), 31)) == 31
