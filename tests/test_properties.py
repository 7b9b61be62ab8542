"""Invariants of the registered queries on the smallest test data."""

import numpy as np

import __spark_entry__ as E
from harness import SF_SMALL

Q = E.queries()


def _pdf(spark, name):
    return Q[name](spark, SF_SMALL).toPandas()


def test_budget_shares_sum_to_100(spark):
    b = _pdf(spark, "budget_reallocation")
    assert abs(b.recommended_budget_pct.sum() - 100) <= 0.05 * len(b) + 1e-9
    assert abs(b.current_budget_pct.sum() - 100) <= 0.05 * len(b) + 1e-9
    assert ((b.composite_score >= 0) & (b.composite_score <= 1)).all()


def test_cohort_month_zero_is_one(spark):
    c = _pdf(spark, "cohort_retention")
    assert np.allclose(c[c.period == 0].retained_vs_m0, 1.0)
    assert (c.retained_vs_cohort <= 1.0 + 1e-12).all()


def test_survival_non_increasing(spark):
    km = _pdf(spark, "km_table").sort_values("time")
    assert (np.diff(km.survival.values) <= 1e-12).all() and (km.survival.between(0, 1)).all()
    assert (np.diff(km.n_at_risk.values) <= 0).all()


def test_lorenz_and_gini_bounds(spark):
    lz = _pdf(spark, "lorenz_ltv").sort_values("value")
    assert abs(lz.value_share.iloc[-1] - 1) < 1e-9 and abs(lz.pop_share.iloc[-1] - 1) < 1e-12
    g = _pdf(spark, "gini_ltv").gini.iloc[0]
    assert 0 <= g <= 1


def test_histogram_counts_cover_rows(spark):
    h = _pdf(spark, "histogram_clv")
    abt = _pdf(spark, "abt")
    assert h.n.sum() == abt.total_revenue.notna().sum() and len(h) == 30


def test_decile_sizes_differ_by_at_most_one(spark):
    d = _pdf(spark, "eval_deciles")
    assert d["count"].max() - d["count"].min() <= 1 and len(d) == 10


def test_quality_scores_in_range(spark):
    q = _pdf(spark, "quality_scores")
    assert q.score.between(0, 100).all() and set(q.status) <= {"Healthy", "Warning", "Critical"}
