"""Shared-scan k-means against plain Lloyd steps and a pairwise silhouette."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from campanula.operators import kmeans as K
from campanula.operators import ml as M


def _frame(spark, x):
    rows = [(f"k{i}", [float(v) for v in p]) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "id string, a array<double>").withColumn("features", array_to_vector("a")).repartition(3).cache()


def _planted(seed=3, n=240, centres=((0, 0, 0), (9, 9, 0), (-9, 9, 5), (0, -12, 3))):
    rng = np.random.default_rng(seed)
    return np.vstack([rng.normal(size=(n // len(centres), 3)) + c for c in centres])


def _near(x, c):
    return ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)


def test_planted_clusters_and_fixed_point(spark):
    x = _planted()
    df = _frame(spark, x)
    models = K.fit(df, [2, 4], "id", restarts=4)
    four = models[4]
    d = ((x[:, None] - four.centres[None]) ** 2).sum(2)
    assert np.isclose(four.inertia, d.min(1).sum(), rtol=1e-9) and four.inertia < models[2].inertia
    near = d.argmin(1)
    assert sorted(np.bincount(near).tolist()) == [60] * 4  # the planted groups
    assert np.allclose(four.centres, np.array([x[near == k].mean(0) for k in range(4)]), atol=1e-3)
    got = {r.id: r.prediction for r in four.transform(df).collect()}
    assert [got[f"k{i}"] for i in range(len(x))] == near.tolist()
    again = K.fit(df.repartition(7), [2, 4], "id", restarts=4)
    assert all(np.allclose(again[k].centres, models[k].centres) for k in models)


def test_restarts_never_hurt(spark):
    df = _frame(spark, np.random.default_rng(8).normal(size=(150, 4)))
    one, ten = (K.fit(df, [5], "id", restarts=r)[5].inertia for r in (1, 10))
    assert ten <= one


def test_silhouette_against_all_pairs(spark):
    x = _planted(5, 80)
    df = _frame(spark, x)
    models = K.fit(df, [2, 3, 4], "id", restarts=3)
    got = K.silhouettes(df, models)
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    for k, m in models.items():
        near = _near(x, m.centres)
        s = []
        for i in range(len(x)):
            own = near == near[i]
            a = d[i, own].sum() / max(own.sum() - 1, 1)
            b = min(d[i, near == c].mean() for c in set(near) - {near[i]})
            s.append((b - a) / max(a, b) if own.sum() > 1 else 0.0)
        assert np.isclose(got[k], np.mean(s), rtol=1e-9)
    assert max(got, key=got.get) == 4


@pytest.mark.parametrize("x", [np.zeros((6, 2)), np.array([[1.0, 2.0]])])
def test_fewer_points_than_clusters(spark, x):
    df = _frame(spark, x)
    models, table = K.sweep(df, [2, 3], "id", restarts=2)
    assert all(m.inertia == 0.0 for m in models.values()) and table.filter("silhouette is not null").count() == 0


def test_empty(spark):
    df = _frame(spark, np.zeros((1, 2))).filter("1 = 0")
    models, table = K.sweep(df, [2], "id")
    assert models == {} and table.count() == 0


def test_campaign_groups_pick_the_planted_number(spark):
    x = _planted(1, 120)
    rows = [(f"c{i}", float(p[0]), int(50 + p[1]), float(p[2]), float(p[0] + p[1])) for i, p in enumerate(x)]
    df = spark.createDataFrame(rows, "campaign_id string, spend_usd double, total_leads long, LCR double, ROAS double")
    out = M.group_campaigns(df)
    assert out.select("Group").distinct().count() == 4 and out.count() == len(rows)
    few = M.group_campaigns(df.limit(2))
    assert few.select(F.max("Group")).first()[0] == 0 and few.count() == 2
