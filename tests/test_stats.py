"""Statistics: golden values from the reference's published tables, brute
force on small fixtures, and invariants."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from campanula.functions.pvalues import p_value
from campanula.operators import stats as S

# --- fixed values: published contingency counts (n, conversions) ------------
CHANNEL_COUNTS = {"email": (882, 356), "paid search": (1147, 447), "search": (426, 164),
                  "affiliate": (446, 157), "paid social": (1572, 545), "display": (292, 95),
                  "influencer": (419, 133)}
OBJECTIVE_COUNTS = {"Awareness": (1446, 539), "Conversion": (970, 335), "Lead Gen": (1766, 658),
                    "Retention": (1002, 365)}
LANDING_COUNTS = {"a": (891, 353), "b": (895, 344), "c": (859, 321), "d": (873, 308), "e": (832, 289),
                  "f": (874, 294)}
# -----------------------------------------------------------------------------


def _chi2_tail(spark, x, df):
    return spark.range(1).select(p_value("chi2", F.lit(x), F.lit(df)).alias("p")).first().p


def _from_counts(spark, counts):
    rows = []
    for k, (n, c) in counts.items():
        rows += [(k, True)] * c + [(k, False)] * (n - c)
    return spark.createDataFrame(rows, "a string, y boolean")


def test_chi2_golden_channel(spark):
    r = S.chi2_flag(_from_counts(spark, CHANNEL_COUNTS), "a", F.col("y"), "t").collect()[0]
    assert round(r.statistic, 3) == 18.066 and r.df1 == 6
    assert round(_chi2_tail(spark, r.statistic, r.df1), 4) == 0.0061


def test_chi2_golden_objective_and_landing(spark):
    r = S.chi2_flag(_from_counts(spark, OBJECTIVE_COUNTS), "a", F.col("y"), "t").collect()[0]
    assert round(r.statistic, 3) == 2.409 and r.df1 == 3 and round(_chi2_tail(spark, r.statistic, 3), 4) == 0.4920
    r = S.chi2_flag(_from_counts(spark, LANDING_COUNTS), "a", F.col("y"), "t").collect()[0]
    assert round(r.statistic, 3) == 10.221 and round(r.cramers_v, 3) == 0.044
    assert round(_chi2_tail(spark, r.statistic, 5), 4) == 0.0692


def test_chi2_yates_2x2_and_order_invariance(spark):
    df = _from_counts(spark, {"x": (40, 10), "z": (60, 30)})
    a = S.chi2_flag(df, "a", F.col("y"), "t").collect()[0].statistic
    b = S.chi2_flag(df.orderBy(F.rand(3)), "a", F.col("y"), "t").collect()[0].statistic
    # hand computation with Yates' correction
    obs = np.array([[10, 30], [30, 30]], float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    d = np.abs(obs - e) - np.minimum(0.5, np.abs(obs - e))
    assert math.isclose(a, (d * d / e).sum(), rel_tol=1e-12) and math.isclose(a, b, rel_tol=1e-12)


def _rank_fixture(spark, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"g": rng.choice(list("abcd"), 500), "v": rng.integers(0, 30, 500).astype(float)})
    pdf.loc[:150, "v"] = 7.0  # heavy ties
    return spark.createDataFrame(pdf), pdf


def test_kruskal_brute_force(spark):
    df, pdf = _rank_fixture(spark)
    h = S.kruskal(df, "g", "v", "t").collect()[0].statistic
    r = pdf.v.rank()
    n = len(pdf)
    h0 = 12 / (n * (n + 1)) * sum(r[pdf.g == g].sum() ** 2 / (pdf.g == g).sum() for g in "abcd") - 3 * (n + 1)
    t = pdf.v.value_counts().values.astype(float)
    assert math.isclose(h, h0 / (1 - (t ** 3 - t).sum() / (n ** 3 - n)), rel_tol=1e-9)


def test_mann_whitney_brute_force(spark):
    df, pdf = _rank_fixture(spark)
    x = pdf.g == "a"
    r = S.mann_whitney(df, F.col("g") == "a", "v", "t").collect()[0]
    ranks = pdf.v.rank()
    n1, n2 = x.sum(), (~x).sum()
    u1 = ranks[x].sum() - n1 * (n1 + 1) / 2
    assert math.isclose(r.statistic, u1, rel_tol=1e-12) and r.n1 == n1 and r.n2 == n2
    # AUC identity: U1 / (n1 n2) of a variable against its own negation sums to 1
    r2 = S.mann_whitney(df.withColumn("v", -F.col("v")), F.col("g") == "a", "v", "t").collect()[0]
    assert math.isclose(r.statistic + r2.statistic, n1 * n2, rel_tol=1e-12)


def test_anova_and_welch_brute_force(spark):
    df, pdf = _rank_fixture(spark)
    f = S.anova(df, "g", "v", "t").collect()[0]
    groups = [pdf.v[pdf.g == g].values for g in "abcd"]
    gm = pdf.v.mean()
    ssb = sum(len(x) * (x.mean() - gm) ** 2 for x in groups)
    ssw = sum(((x - x.mean()) ** 2).sum() for x in groups)
    assert math.isclose(f.statistic, (ssb / 3) / (ssw / (len(pdf) - 4)), rel_tol=1e-9)
    w = S.welch_t(df, F.col("g") == "a", "v", "t").collect()[0]
    a, b = pdf.v[pdf.g == "a"], pdf.v[pdf.g != "a"]
    t = (a.mean() - b.mean()) / math.sqrt(a.var() / len(a) + b.var() / len(b))
    assert math.isclose(w.statistic, t, rel_tol=1e-9)


def test_spearman_and_point_biserial(spark):
    df, pdf = _rank_fixture(spark)
    pdf["w"] = pdf.v * 0.5 + (pdf.index % 7)
    sdf = spark.createDataFrame(pdf)
    rho = S.spearman(sdf, "v", "w", "t").collect()[0].statistic
    assert math.isclose(rho, pdf.v.rank().corr(pdf.w.rank()), rel_tol=1e-9)
    pb = S.point_biserial(sdf, F.col("g") == "a", F.col("v"), "t").collect()[0].statistic
    assert math.isclose(pb, (pdf.g == "a").astype(float).corr(pdf.v), rel_tol=1e-9)


def test_constant_flag_gives_null_not_error(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True), (3.0, True)], "v double, f boolean")
    assert S.point_biserial(df, F.col("f"), F.col("v"), "t").collect()[0].statistic is None


def test_p_value_functions(spark):
    df = spark.sql("SELECT * FROM VALUES ('t2', 2.0D, 10.0D, null), ('f', 3.0D, 2.0D, 20.0D), ('chi2', 0.5D, 1.0D, null) AS t(dist, x, a, b)")
    got = {r.dist: round(r.p, 4) for r in df.select("dist", p_value("dist", "x", "a", "b").alias("p")).collect()}
    assert got == {"t2": 0.0734, "f": 0.0725, "chi2": 0.4795}


def test_chi2_of_general_tables(spark):
    """r x c tables from their non-empty cells against the dense grid; golden value of the published landing-page table."""
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"a": rng.choice(list("pqrst"), 800), "b": rng.choice(list("xyz"), 800, p=[.7, .25, .05]),
                        "many": rng.integers(0, 400, 800).astype(str), "one": "only", "f": rng.random(800) < 0.3})
    pdf.loc[pdf.a == "p", "b"] = "x"  # empty cells
    df = spark.createDataFrame(pdf).withColumn("null", F.lit(None).cast("string"))
    pairs = {"ab": ("a", "b"), "many": ("many", "a"), "one": ("one", "b"), "af": ("a", "f"), "null": ("null", "a"),
             "2x2": (F.col("a") == "q", F.col("f"))}
    got = {r.test: r for r in S.chi2_from_cells(S.contingency(df, pairs)).collect()}
    pdf["2"] = (pdf.a == "q").astype(str)
    for name, a, b in (("ab", "a", "b"), ("many", "many", "a"), ("af", "a", "f"), ("2x2", "2", "f")):
        o = pd.crosstab(pdf[a], pdf[b]).values.astype(float)
        e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
        d = np.abs(o - e)
        d = d - np.minimum(0.5, d) if o.shape == (2, 2) else d
        chi2 = (d * d / e).sum()
        assert math.isclose(got[name].statistic, chi2, rel_tol=1e-9) and got[name].df1 == (o.shape[0] - 1) * (o.shape[1] - 1)
        assert math.isclose(got[name].cramers_v, math.sqrt(chi2 / (800 * (min(o.shape) - 1))), rel_tol=1e-9)
    assert got["one"].df1 == 0 and got["one"].cramers_v is None and abs(got["one"].statistic) < 1e-9 and "null" not in got
    r = S.chi2_from_cells(S.contingency(_from_counts(spark, LANDING_COUNTS), {"t": ("a", "y")})).collect()[0]
    assert round(r.statistic, 3) == 10.221 and round(r.cramers_v, 3) == 0.044


def test_stacked_rank_tests(spark):
    """Several tests in one ordered pass: average ranks, groups of one value, no data, one-sided form."""
    df, pdf = _rank_fixture(spark)
    neg = df.withColumn("v", -F.col("v"))
    ranks = S.stacked_ranks(S.stacked_counts({"a": (df, "g", "v"), "b": (neg, F.lit("all"), "v")})).toPandas()
    for test, values in (("a", pdf.v), ("b", -pdf.v)):
        want = dict(zip(values, values.rank()))
        part = ranks[ranks.test == test]
        assert dict(zip(part._v, part["rank"])) == want and part._c.sum() == len(pdf)
    lone = df.unionByName(spark.createDataFrame([("z", 5.0), (None, 1.0), ("a", None), ("a", float("nan"))], "g string, v double"))
    out = {r.test: r for r in S.kruskal_tests({"t": (df, "g", "v"), "lone": (lone, "g", "v"), "none": (df.filter("1=0"), "g", "v")}).collect()}
    assert math.isclose(out["t"].statistic, out["lone"].statistic, rel_tol=1e-12) and out["none"].statistic is None
    mw = {r.test: r for r in S.mann_whitney_tests({"two": (df, F.col("g") == "a", "v"), "up": (df, F.col("g") == "a", "v", "greater"),
                                                   "down": (df, F.col("g") != "a", "v", "greater")}).collect()}
    assert mw["up"].dist == mw["down"].dist == "norm1" and mw["two"].dist == "norm2"
    assert math.isclose(max(mw["up"].z, mw["down"].z), mw["two"].z, rel_tol=1e-12)
