"""STA-09: tail probabilities against closed forms and a plain numeric integral."""

import math

import numpy as np

from campanula.functions.pvalues import p_value
from campanula.operators import stats as S


def tails(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, dist string, x double, df1 double, df2 double")
    return [r.p for r in df.select("i", p_value("dist", "x", "df1", "df2").alias("p")).orderBy("i").collect()]


def test_closed_forms(spark):
    cases = []
    for z in (0.0, 1e-9, 0.3, 1.96, 5.0, 12.0, 30.0):
        two = math.erfc(z / math.sqrt(2))
        cases += [(("norm2", z, None, None), two), (("norm2", -z, None, None), two), (("norm1", z, None, None), two / 2),
                  (("norm1", -z, None, None), 1 - two / 2), (("chi2", z * z, 1.0, None), two)]
    for x in (1e-6, 0.5, 4.0, 60.0, 900.0):
        poisson = [math.exp(-x / 2 + i * math.log(x / 2) - math.lgamma(i + 1)) for i in range(200)]
        cases += [(("chi2", x, 2.0 * m, None), sum(poisson[:m])) for m in (1, 2, 10, 200)]  # even degrees: a Poisson sum
        cases += [(("f", x, 2.0, d), (1 + 2 * x / d) ** (-d / 2)) for d in (1.0, 7.0, 300.0, 1e6)]
        cases += [(("f", x, d, 2.0), -math.expm1(-d / 2 * math.log1p(2 / (d * x)))) for d in (1.0, 9.0, 500.0)]
    for t in (1e-6, 0.7, 3.0, 1e5, 1e9):
        cases += [(("t2", t, 1.0, None), 2 / math.pi * math.atan2(1, t)),
                  (("t2", -t, 2.0, None), 2 / (math.sqrt(t * t + 2) * (math.sqrt(t * t + 2) + t)))]
    for (case, want), got in zip(cases, tails(spark, [c for c, _ in cases])):
        assert math.isclose(got, want, rel_tol=1e-8, abs_tol=1e-300), (case, want, got)


def test_many_degrees_against_a_fine_grid(spark):
    def grid(log_density, cut, lo, hi):
        area = []
        for a, b in ((lo, cut), (cut, hi)):
            v = np.linspace(a, b, 400_001)
            area.append(np.trapezoid(np.exp(log_density(v) - max(log_density(np.linspace(lo, hi, 10_001)))), v))
        return area[1] / sum(area)
    for d1, d2, x in ((4.0, 60_000.0, 2.5), (37.0, 11.0, 0.4), (200.0, 3_000.0, 1.3), (1.0, 5e5, 9.0)):
        want = grid(lambda v: d1 / 2 * v - (d1 + d2) / 2 * np.log1p(np.exp(v)), math.log(x * d1 / d2), -60.0, 30.0)
        assert math.isclose(tails(spark, [("f", x, d1, d2)])[0], want, rel_tol=1e-6)
    for k, x in ((3.0, 7.8), (1_001.0, 1_100.0), (50_001.0, 49_000.0)):
        want = grid(lambda v: k / 2 * v - np.exp(v), math.log(x / 2), -20.0, 14.0)
        assert math.isclose(tails(spark, [("chi2", x, k, None)])[0], want, rel_tol=1e-6)


def test_undefined_inputs_and_limits(spark):
    rows = [("chi2", None, 1.0, None), ("chi2", 1.0, None, None), ("chi2", 1.0, 0.0, None), ("t2", 1.0, -1.0, None),
            ("f", 1.0, 2.0, None), ("f", float("nan"), 2.0, 3.0), ("other", 1.0, 1.0, 1.0), (None, 1.0, 1.0, 1.0)]
    assert tails(spark, rows) == [None] * len(rows)
    inf = float("inf")
    assert tails(spark, [("chi2", -1.0, 3.0, None), ("f", 0.0, 1.0, 1.0), ("f", inf, 2.0, 3.0), ("norm1", -inf, None, None),
                         ("norm1", inf, None, None), ("chi2", 1e6, 2.0, None), ("chi2", 1e-9, 5e4, None)]) == [1.0, 1.0, 0.0, 1.0, 0.0, 0.0, 1.0]


def test_no_python_worker(spark):
    df = spark.createDataFrame([("chi2", 1.0, 1.0, None)], "dist string, statistic double, df1 double, df2 double")
    assert "Python" not in S.with_p_values(df)._jdf.queryExecution().executedPlan().toString()
