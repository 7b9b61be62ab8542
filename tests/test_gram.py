"""Regressions from Gram sums against dense least squares and plain Newton steps."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from campanula.operators import gram as GR
from campanula.operators import ml as M


def _data(n=900, seed=4):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": [f"r{i}" for i in range(n)], "x1": 1e6 + rng.normal(size=n), "x2": rng.exponential(size=n),
                        "c": rng.choice(["p", "q", "r", "s"], n), "d": rng.choice(["u", "v"], n), "one": "only"})
    pdf["y"] = 3 * (pdf.x1 - 1e6) - 2 * pdf.x2 + pdf.c.map({"p": 0, "q": 5, "r": -4, "s": 1}) + rng.normal(size=n) + 1e5
    pdf["z"] = (rng.random(n) < 1 / (1 + np.exp(-(0.8 * (pdf.x1 - 1e6) - pdf.x2 + (pdf.c == "q"))))).astype(int)
    return pdf


def _dummies(pdf, cats, drop):
    return np.hstack([np.stack([(pdf[c] == v).astype(float) for v in sorted(pdf[c].unique())[drop:]], 1)
                      for c in cats if pdf[c].nunique() > drop])


def test_least_squares_equals_dense(spark):
    pdf = _data()
    df = spark.createDataFrame(pdf).repartition(5)
    rows = GR.frame(df, "y", ["x1", "x2"], ["c", "d", "one"])
    d = GR.design(rows, ["x1", "x2"], ["c", "d", "one"])
    assert d.names == ["x1", "x2", "c_q", "c_r", "c_s", "d_v"]  # one level: no column
    g = GR.gram(rows, d)[0]
    x = np.hstack([np.ones((len(pdf), 1)), pdf[["x1", "x2"]].values - pdf[["x1", "x2"]].values.mean(0), _dummies(pdf, ["c", "d"], 1)])
    want = np.linalg.lstsq(x, pdf.y.values - pdf.y.mean(), rcond=None)[0]
    coefs, standard = GR.least_squares(g)
    assert np.allclose(coefs, want, rtol=1e-6, atol=1e-6)
    assert np.allclose(standard, want[1:] * x[:, 1:].std(0, ddof=1), rtol=1e-6, atol=1e-6)
    assert math.isclose(GR.squared_error(g, coefs), ((pdf.y - pdf.y.mean() - x @ want) ** 2).sum(), rel_tol=1e-6)
    full = np.hstack([np.ones((len(pdf), 1)), pdf[["x1", "x2"]].values, _dummies(pdf, ["c", "d"], 1), pdf[["y"]].values])
    assert np.allclose(GR.raw_sums(g, d), full.T @ full, rtol=1e-9)


@pytest.mark.parametrize("ridge,standardise", [(1.0, True), (1.0, False), (0.0, True)])
def test_logit_equals_newton(spark, ridge, standardise):
    pdf = _data()
    pdf["x1"] -= 1e6 - 3
    df = spark.createDataFrame(pdf).repartition(4)
    fit = GR.fit_logit(GR.frame(df, "z", ["x1", "x2"], ["c", "one"]), ["x1", "x2"], ["c", "one"], ridge=ridge, standardise=standardise,
                       drop_first=ridge == 0)
    x = np.hstack([pdf[["x1", "x2"]].values, _dummies(pdf, ["c", "one"], int(ridge == 0))])
    s = x.std(0)
    raw = x.copy()
    if standardise:
        x = (x - x.mean(0)) / np.where(s > 0, s, 1)
    x = np.hstack([np.ones((len(x), 1)), x])
    b, pen = np.zeros(x.shape[1]), ridge * np.append(0, np.ones(x.shape[1] - 1))
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ b))
        h = x.T @ (x * (p * (1 - p))[:, None]) + np.diag(pen)
        b = b + np.linalg.lstsq(h, x.T @ (pdf.z.values - p) - pen * b, rcond=None)[0]
    live = s > 0
    assert np.allclose(fit.scaled[live], b[1:][live], rtol=1e-6, atol=1e-7) and (fit.scaled[~live] == 0).all()
    p = 1 / (1 + np.exp(-x @ b))
    got = df.select("id", fit.score().alias("p")).toPandas().set_index("id").p[pdf.id].values
    assert np.allclose(got, p, atol=1e-7) and raw.shape[1] == len(fit.design.names)


def test_defined_results_without_anything_to_fit(spark):
    pdf = _data(60)
    df = spark.createDataFrame(pdf).withColumn("same", F.lit(7.0)).withColumn("all", F.lit(1)).withColumn("null", F.lit(None).cast("string"))
    row = M.mlr(df, "same", ["x1"], "constant", "id", ["c"]).first()
    assert row.R2 is None and row.Adj_R2 is None and row.n_train + row.n_test == 60 and row.top_predictor is None
    row = M.mlr(df.filter("1 = 0"), "y", ["x1"], "empty", "id", ["c"]).first()
    assert tuple(row)[1:] == (None, None, 0, 0, None)
    row = M.mlr(df, "y", ["x1", "same"], "one level", "id", ["one", "null"]).first()
    assert row.R2 is not None and row.top_predictor == "x1"
    assert [r.scaled_coef for r in M.logit_table(df, "all", ["x1"], ["c"]).collect()] == [None] * 5
    assert M.logit_table(df.filter("1 = 0"), "z", ["x1"], ["c"]).collect()[0].p_value is None
    assert {r.ps for r in M.propensity_scores(df, "all", ["x1"], ["c"]).collect()} == {None}


def test_planted_signal_and_p_values(spark):
    pdf = _data(2000)
    pdf["x1"] -= 1e6
    pdf["noise"] = np.random.default_rng(9).normal(size=len(pdf))
    out = {r.feature: r for r in M.logit_table(spark.createDataFrame(pdf), "z", ["x1", "noise"], ["c"]).collect()}
    assert out["x1"].scaled_coef > 0.5 and out["x1"].p_value < 1e-6 < 0.01 < out["noise"].p_value and len(out) == 6
    r = M.mlr(spark.createDataFrame(pdf), "y", ["x1", "x2"], "m", "id", ["c"]).first()
    assert r.R2 > 0.9 and r.top_predictor == "x1" and 0.7 < r.n_train / len(pdf) < 0.8


def test_too_many_levels_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(GR, "MAX_COLUMNS", 3)
    rows = GR.frame(spark.createDataFrame(_data(60)), "y", ["x1"], ["c"])
    with pytest.raises(ValueError, match="columns"):
        GR.design(rows, ["x1"], ["c"])
