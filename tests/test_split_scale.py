"""Dates, splits and tree fits at scale: the same results without formatters, ordered copies or crowded tasks."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from campanula.functions import clean as C
from campanula.operators import ml as M


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_impossible_dates_have_no_shape(spark):
    vals = ["1996-02-29", "1995-02-29", "12/31/1995", "31/12/1995", "30-12-1995", "sep 30, 1995", "Sep 31, 1995", "Foo 01, 1995",
            "Feb 3, 1995", "1995-01-01\n", "1995-01-01 10:11:12", "1995-01-01 25:11:12", "0000-01-01", None, ""]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    s = F.trim("x")
    plain = F.coalesce(*[F.to_date(F.try_to_timestamp(s, F.lit(f))) for f in C.DATE_FORMATS])
    assert all(r.a == r.b for r in df.select(C.parse_date("x").cast("string").alias("a"), plain.cast("string").alias("b")).collect())
    day_first = spark.createDataFrame([("31/12/1995",), ("12/31/1995",)], "x string")
    assert [r[0] for r in day_first.select(F.col("x").rlike(C.date_shape("MM/dd/yyyy"))).collect()] == [False, True]


def test_split_is_exact_and_moves_no_rows(spark):
    rows = [(i, float(i % 3 == 0), f"v{i}") for i in range(997)] + [(None, 1.0, f"n{i}") for i in range(50)] + [(5, 0.0, f"d{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, label double, v string").unionByName(
        spark.createDataFrame([(1, None, "no label")], "id long, label double, v string"))
    train, test = M.stratified_split(df, "label", "id")
    for label, n in ((0.0, 664 + 40), (1.0, 333 + 50)):
        assert train.filter(F.col("label") == label).count() == n * 3 // 4
        assert train.unionByName(test).filter(F.col("label") == label).select("v").distinct().count() == n
    h = F.xxhash64(F.col("id").cast("string"), F.lit(M.SEED))
    w = Window.partitionBy("label").orderBy(h)
    want = df.filter("label is not null").withColumn("lo", F.rank().over(w)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("label")))
    sure = {r.v for r in want.withColumn("k", F.count(F.lit(1)).over(Window.partitionBy("label", h))).filter("lo + k - 1 <= floor(n * 0.75)").collect()}
    assert sure <= {r.v for r in train.collect()}
    assert "RepartitionByExpression" not in _plan(train)


def test_split_of_tiny_strata(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 1.0)], "id long, label double")
    train, test = M.stratified_split(df, "label", "id")
    assert train.count() == 1 and test.count() == 2
    empty = [p.count() for p in M.stratified_split(df.limit(0), "label", "id")]
    assert empty == [0, 0]


def test_forest_rows_are_dealt_over_tasks(spark):
    df = spark.range(1000).coalesce(1)
    assert M._dealt(df, per_task=10).rdd.getNumPartitions() == 100
    assert M._dealt(df).rdd.getNumPartitions() == 1


class _Slow:
    """An estimator that meets its fellows: its fit ends when all of them have begun."""

    def __init__(self, gate):
        self.gate = gate

    def copy(self):
        return self

    def fit(self, rows):
        self.gate.wait(timeout=60)
        return rows.count()


def test_all_models_are_fitted_together(spark):
    import threading
    gate = threading.Barrier(4)
    rows = spark.range(30).selectExpr("cast(id % 2 as double) as label", "id as features", "1.0 as weight", "id")
    parts = {f: rows.filter(F.col("id") % 2 != f) for f in (0, 1)}
    assert set(M._fit_all({"a": _Slow(gate), "b": _Slow(gate)}, parts).values()) == {15}


def test_permuted_copies_are_scored_without_the_fitted_stages(spark, monkeypatch):
    """Each copy's score is the model's own; the encoder and the model see a row once, not once per column."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression

    rng = np.random.default_rng(3)
    rows = [(f"k{i}", float(rng.random() < 1 / (1 + np.exp(-x - (i % 3)))), float(x), float(i % 4), "abc"[i % 3], "uv"[i % 2], "one")
            for i, x in enumerate(rng.normal(size=400))]
    df = spark.createDataFrame(rows, "id string, label double, x double, z double, c string, d string, e string")
    scored, auc = [], M.EV.auc
    monkeypatch.setattr(M.EV, "auc", lambda p, **k: (scored.append(p), auc(p, **k))[1])
    columns = ["x", "c", "d", "e"]  # z is in the model but not permuted, e has one level
    got = {r.feature: r for r in M.permutation_importance(df, ["x", "z"], ["c", "d", "e"], "id", columns).collect()}
    assert "UDF" not in _plan(scored[0])

    train, held = M.stratified_split(df, "label", "id")
    enc = Pipeline(stages=M.feature_stages(["x", "z"], ["c", "d"])).fit(df)
    model = LogisticRegression(maxIter=200, weightCol="weight").fit(enc.transform(train.withColumn("weight", M.balanced_weight(train))))
    held = held.withColumn("_h", F.xxhash64("id", F.lit(M.SEED))).toPandas().sort_values("id").reset_index(drop=True)
    partner = held.sort_values(["_h", "id"]).reset_index(drop=True)

    def plain(frame):
        p = M._prob(model.transform(enc.transform(spark.createDataFrame(frame.drop(columns="_h"))))).select("label", "score").toPandas()
        pos, neg = p.score[p.label == 1].to_numpy()[:, None], p.score[p.label == 0].to_numpy()[None]
        return float(((pos > neg) + (pos == neg) / 2).mean())
    assert set(got) == {"x", "c", "d"}
    for c, r in got.items():
        assert r.base_auc == pytest.approx(plain(held), abs=1e-9)
        assert r.permuted_auc == pytest.approx(plain(held.assign(**{c: partner[c]})), abs=1e-9)
        assert r.auc_drop == pytest.approx(r.base_auc - r.permuted_auc, abs=1e-12)
