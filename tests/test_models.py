"""Model operators: properties (fits are seeded but engine-specific)."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from campanula.operators import ml as M


def _frame(spark, n=1200, seed=1):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.35).astype(float)
    pdf = pd.DataFrame({"id": np.arange(n), "label": y, "x1": rng.normal(size=n) + 1.5 * y,
                        "x2": rng.normal(size=n), "c": rng.choice(["p", "q", "r"], n)})
    return spark.createDataFrame(pdf)


def test_stratified_split_is_exact_per_class(spark):
    df = _frame(spark)
    train, test = M.stratified_split(df, "label", "id")
    counts = df.groupBy("label").count().toPandas().set_index("label")["count"]
    tr = train.groupBy("label").count().toPandas().set_index("label")["count"]
    for lab, n in counts.items():
        assert tr[lab] == int(np.floor(n * 0.75))
    assert train.count() + test.count() == df.count()
    assert train.join(test, "id").count() == 0


def test_folds_are_balanced(spark):
    f = M.with_folds(_frame(spark), "label", "id", 5).groupBy("fold", "label").count().toPandas()
    for _, g in f.groupby("label"):
        assert g["count"].max() - g["count"].min() <= 1


def test_model_comparison_beats_chance(spark):
    from pyspark.ml.classification import LogisticRegression, NaiveBayes
    res = M.compare_models(_frame(spark), ["x1", "x2"], ["c"], "id",
                           models={"lr": LogisticRegression(weightCol="weight"),
                                   "nb": NaiveBayes(modelType="gaussian")}, folds=3).toPandas()
    assert (res.auc_test > 0.7).all() and (res.cv_auc > 0.7).all() and res.selected.sum() == 1


def test_bootstrap_interval(spark):
    """Close to the normal interval of the mean; the same whatever the row order; few and no rows."""
    df = _frame(spark)
    r = M.blocked_bootstrap_ci(df, "x1", "id").collect()[0]
    x = df.toPandas().x1
    half = 1.96 * x.std() / np.sqrt(len(x))
    assert abs(r.mean - x.mean()) < 1e-9 and r.n_boot == 2000
    assert abs(r.ci_low - (x.mean() - half)) < 0.2 * half and abs(r.ci_high - (x.mean() + half)) < 0.2 * half
    again = M.blocked_bootstrap_ci(df.repartition(7, "x2"), "x1", "id").collect()[0]
    assert np.allclose(tuple(again), tuple(r), rtol=1e-12)
    few = M.blocked_bootstrap_ci(df.limit(1), "x1", "id", n_boot=50).collect()[0]
    assert np.allclose([few.ci_low, few.ci_high], few.mean, rtol=1e-12)
    none = M.blocked_bootstrap_ci(df.filter("1 = 0"), "x1", "id", n_boot=50).collect()[0]
    assert none.mean is None and none.ci_low is None


def test_one_level_and_one_class(spark):
    """A category with one level has no column in any model; one class has nothing to compare."""
    from pyspark.ml.classification import LogisticRegression
    df = _frame(spark, 300).withColumn("one", F.lit("only"))
    models = {"lr": LogisticRegression(weightCol="weight")}
    res = M.compare_models(df, ["x1", "x2"], ["c", "one"], "id", models=models, folds=2).first()
    assert res.auc_test > 0.6 and res.selected
    assert M.score_with(df, ["x1"], ["one"], models["lr"]).filter("predicted_prob is null").count() == 0
    perm = M.permutation_importance(df, ["x1"], ["one"], "id", ["x1", "one"]).collect()
    assert [r.feature for r in perm] == ["x1"]
    flat = M.compare_models(df.withColumn("label", F.lit(1.0)), ["x1"], ["c"], "id", models=models, folds=2).collect()
    assert [(r.model, r.auc_test, r.selected) for r in flat] == [("lr", None, False)]


def test_dummies_one_column_less_than_levels(spark):
    from pyspark.ml import Pipeline
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("b", 4.0)], "c string, x double")
    out = Pipeline(stages=M.feature_stages(["x"], ["c"])).fit(df).transform(df)
    rows = {(r["c"], r["x"]): r["features"].toArray().tolist() for r in out.collect()}
    assert rows == {("a", 1.0): [1.0, 0.0, 0.0], ("b", 2.0): [2.0, 0.0, 1.0], ("c", 3.0): [3.0, 1.0, 0.0], ("b", 4.0): [4.0, 0.0, 1.0]}
