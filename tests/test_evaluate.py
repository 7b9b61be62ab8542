"""Evaluation / survival operators against brute force and invariants."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from campanula.operators import evaluate as EV


def _pred(spark, n=2000, seed=11):
    rng = np.random.default_rng(seed)
    y = rng.random(n) < 0.4
    s = np.clip(np.round(rng.random(n) * 0.6 + y * 0.3, 2), 0, 1)
    pdf = pd.DataFrame({"id": np.arange(n), "label": y, "score": s})
    return spark.createDataFrame(pdf), pdf


def test_auc_rank_identity(spark):
    df, pdf = _pred(spark)
    a = EV.auc(df).collect()[0].auc
    pos, neg = pdf.score[pdf.label].values, pdf.score[~pdf.label].values
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert math.isclose(a, brute, rel_tol=1e-12)
    b = EV.auc(df.withColumn("score", -F.col("score"))).collect()[0].auc
    assert math.isclose(a + b, 1.0, rel_tol=1e-12)


def test_cost_threshold_brute_force(spark):
    df, pdf = _pred(spark)
    out = EV.cost_threshold(df).orderBy("threshold").toPandas()
    costs = []
    for t in np.linspace(0, 1, 101):
        p = pdf.score >= t
        costs.append(20 * (pdf.label & ~p).sum() + 5 * (~pdf.label & p).sum())
    assert out.cost.tolist() == [float(c) for c in costs]
    assert out.is_optimal.sum() == 1 and out.is_optimal.values.argmax() == int(np.argmin(costs))


def test_decile_golden_cumulative_rate(spark):
    # published deciles: sizes and conversions -> cumulative rates at 10 and 1
    sizes = [131, 131, 130, 131, 130, 131, 130, 131, 130, 131]
    conv = [28, 35, 37, 42, 52, 46, 59, 54, 57, 67]
    rows, k = [], 0
    for d, (n, c) in enumerate(zip(sizes, conv)):
        for i in range(n):
            rows.append((k, i < c, d + i / 1000.0))  # score increases with decile
            k += 1
    df = spark.createDataFrame(rows, "id long, label boolean, score double")
    t = EV.decile_table(df, "id").orderBy("decile").toPandas()
    assert t["count"].tolist() == sizes and t.conversions.tolist() == conv
    assert round(t.cumulative_rate.iloc[9], 5) == 0.51145 and round(t.cumulative_rate.iloc[0], 6) == 0.365237


def test_kaplan_meier_brute_force(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"t": rng.integers(0, 60, 800), "e": rng.random(800) < 0.6,
                        "g": rng.choice(["a", "b"], 800)})
    km = EV.kaplan_meier(spark.createDataFrame(pdf), "t", "e").orderBy("time").toPandas()
    s, exp = 1.0, []
    for t in sorted(pdf.t.unique()):
        n = (pdf.t >= t).sum()
        d = ((pdf.t == t) & pdf.e).sum()
        s *= 1 - d / n
        exp.append(s)
    assert np.allclose(km.survival.values, exp) and (np.diff(km.survival.values) <= 1e-15).all()
    kg = EV.kaplan_meier(spark.createDataFrame(pdf), "t", "e", by="g").filter("g = 'a'").orderBy("time").toPandas()
    a = pdf[pdf.g == "a"]
    s, exp = 1.0, []
    for t in sorted(a.t.unique()):
        s *= 1 - ((a.t == t) & a.e).sum() / (a.t >= t).sum()
        exp.append(s)
    assert np.allclose(kg.survival.values, exp)


def test_iptw_matches_numpy(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"t": (rng.random(500) < 0.3).astype(float), "y": rng.random(500), "ps": rng.random(500)})
    r = EV.iptw_ate(spark.createDataFrame(pdf), "t", "y", "ps").collect()[0]
    ps = pdf.ps.clip(1e-6, 1 - 1e-6)
    w = pdf.t / ps + (1 - pdf.t) / (1 - ps)
    ate = (w * pdf.t * pdf.y).sum() / (w * pdf.t).sum() - (w * (1 - pdf.t) * pdf.y).sum() / (w * (1 - pdf.t)).sum()
    assert math.isclose(r.ate, ate, rel_tol=1e-9)


def test_grid_cell_exact_at_threshold_neighbours(spark):
    vals = [j * 0.01 for j in range(101)]
    vals += [float(np.nextafter(v, 2)) for v in vals] + [float(np.nextafter(v, -2)) for v in vals]
    vals += [-0.5, 1.5, 0.29, 0.07, 0.57]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(EV.grid_cell(F.col("x"))).collect()]
    assert got == [sum(1 for t in EV.THRESHOLDS if t <= v) for v in vals]
