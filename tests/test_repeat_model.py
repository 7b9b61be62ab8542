import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier

import __spark_entry__
from campanula.operators import evaluate as EV
from campanula.operators import ml as M
from campanula.plans.registry import tables

SF = "/root/testdata/sf0.001"


def small_models():
    return {"Logistic Regression": LogisticRegression(weightCol="weight"), "Random Forest": RandomForestClassifier(numTrees=8, seed=1, weightCol="weight")}


def planted(spark, n=1200):
    return spark.sql(f"""SELECT id, cast(pmod(hash(id, 1), 100) < 10 + 8 * x AS double) AS label, cast(x AS double) AS x, c
                         FROM (SELECT id, pmod(hash(id), 10) AS x, concat('c', id % 3) AS c FROM range({n}))""")


def test_all_features_of_the_repeat_model(spark, monkeypatch):
    seen, select = [], M.select_model
    monkeypatch.setattr(M, "select_model", lambda f, num, cat, key, models: seen.append((list(num), list(cat), list(models)))
                        or select(f, num, cat, key, small_models(), folds=2))
    t = tables(spark, SF)
    monkeypatch.setattr(t, "selections", {})
    queries = __spark_entry__.queries()
    out = queries["clv_projection_model"](spark, SF).collect()
    assert seen == [(["age", "total_acquisition_cost", "total_revenue", "total_sessions", "total_add_to_cart", "avg_pages_viewed"],
                     ["gender", "income_band", "loyalty_tier", "region", "product_category", "payment_type"],
                     ["Logistic Regression", "Random Forest", "Gradient Boosting"])]
    assert out and all(0 <= r.prob_repeat_90d <= 1 and r.projected_clv_6m is not None for r in out)
    assert len(out) == queries["retention_frame"](spark, SF).count()
    assert queries["retention_model_comparison"](spark, SF).filter("selected").count() == 1 and len(seen) == 1  # one fit for both


def test_selected_model_scores_rows_it_has_not_seen(spark):
    """A planted signal: figures of the comparison are those of the stored model on the holdout rows."""
    df = planted(spark)
    chosen = M.select_model(df, ["x"], ["c"], "id", small_models(), folds=3)
    rows = {r.model: r for r in chosen.table.collect()}
    best = max(rows.values(), key=lambda r: r.cv_auc)
    assert best.selected and all(r.cv_auc > 0.65 and r.auc_test > 0.65 for r in rows.values())
    scored = M.score_selected(chosen, df)
    assert scored.count() == 1200 and scored.filter("predicted_prob IS NULL OR priority_tier IS NULL").count() == 0
    held = scored.filter("holdout")
    assert abs(held.count() - 300) <= 2
    assert EV.auc(held, "label", "predicted_prob").first().auc == pytest.approx(best.auc_test, abs=1e-9)


def test_fold_aucs_are_exact(spark):
    """The cross-validated AUC is the mean of exact fold AUCs, from one model a fold."""
    df = planted(spark, 400)
    model = LogisticRegression(weightCol="weight")
    got = M.select_model(df, ["x"], [], "id", {"lr": model}, folds=4).table.first().cv_auc
    folds = M.with_folds(df, "label", "id", 4).toPandas()
    assert folds.groupby("fold").size().max() <= 101
    want = []
    for f in range(4):  # x alone, with a positive weight, orders the rows: the AUC of x itself
        part = folds[folds.fold == f]
        pos, neg = part[part.label == 1].x.values, part[part.label == 0].x.values
        want.append(sum((p > neg).sum() + (p == neg).sum() / 2 for p in pos) / (len(pos) * len(neg)))
    assert got == pytest.approx(sum(want) / 4, abs=1e-9)


def test_one_class_and_single_rows(spark):
    for label in (0.0, 1.0):
        f = spark.createDataFrame([(1, label, 3.0, "a"), (2, label, 4.0, "b")], "id long, label double, x double, c string")
        out = M.score_with(f, ["x"], ["c"], LogisticRegression(weightCol="weight")).collect()
        assert [r.predicted_prob for r in out] == [label] * 2 and all(r.priority_tier for r in out)
        again = M.score_selected(M.select_model(f, ["x"], ["c"], "id", small_models()), f).collect()
        assert [(r.predicted_prob, r.holdout) for r in again] == [(label, False)] * 2
    two = f.withColumn("label", f.id - 1.0)  # one row of either class: nothing to train on
    chosen = M.select_model(two, ["x"], ["c"], "id", small_models())
    assert chosen.table.filter("selected").count() == 0
    assert [r.predicted_prob for r in M.score_selected(chosen, two).collect()] == [None, None]
