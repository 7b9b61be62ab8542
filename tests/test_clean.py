"""CLN-* on the literal dirty tokens of FIXTURES.md section 2."""

import datetime as dt

from pyspark.sql import functions as F

from campanula.functions import clean as C


def _one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_clean_currency(spark):
    vals = ["25081.0", "65,494", "$63,041.00", "USD 70,687.00", "$-5,000.00", "abc", "", None, "12f", "nan"]
    assert _one(spark, vals, C.clean_currency) == [25081.0, 65494.0, 63041.0, 70687.0, -5000.0,
                                                  None, None, None, None, None]


def test_clean_percent(spark):
    assert _one(spark, ["15", "15%", "15 percent", "15 PERCENT", "x"], C.clean_percent) == [15.0] * 4 + [None]


def test_parse_bool(spark):
    assert _one(spark, ["Yes", " TRUE ", "1", "1.0"], C.parse_bool) == [True] * 4
    assert _one(spark, ["no", "0", "y", None], C.parse_bool) == [False] * 4
    assert _one(spark, ["y", "t"], lambda c: C.parse_bool(c, C.TRUTHY_WIDE)) == [True, True]


def test_parse_date(spark):
    vals = ["2025-01-13", "2025/01/26", "01-05-2025", "16/09/2025", "06/06/2025", "Feb 18, 2025", "garbage"]
    got = _one(spark, vals, C.parse_date)
    assert got == [dt.date(2025, 1, 13), dt.date(2025, 1, 26), dt.date(2025, 1, 5), dt.date(2025, 9, 16),
                   dt.date(2025, 6, 6), dt.date(2025, 2, 18), None]


def test_parse_date_matches_plain_coalesce(spark):
    """The shape-gated parser equals the plain first-format-wins chain."""
    vals = ["2025-01-13", "2025/1/26", "13-01-2025", "01-13-2025", "Feb 8, 2025", "Feb 08, 2025",
            "2025-01-13 10:11:12", "2025-13-01", " 2025-01-13 ", "", None, "31/02/2025"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    s = F.trim(F.col("x"))
    plain = F.coalesce(*[F.to_date(F.try_to_timestamp(s, F.lit(f))) for f in C.DATE_FORMATS])
    got = df.select(C.parse_date("x").alias("a"), plain.alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_channel_map(spark):
    got = _one(spark, [" E-mail ", "Paid-Social", "Influencers", "Display"],
               lambda c: C.map_label(c, C.CHANNEL_MAP))
    assert got == ["email", "paid social", "influencer", "display"]


def test_days_between(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 1, 5), dt.datetime(2025, 1, 26)),
         (dt.datetime(2025, 1, 1, 23), dt.datetime(2025, 1, 2, 1)),
         (dt.datetime(2025, 1, 2, 1), dt.datetime(2025, 1, 2, 0))], "s timestamp, e timestamp")
    assert [r[0] for r in df.select(C.days_between("e", "s")).collect()] == [21, 0, -1]


def test_cut_brackets(spark):
    from campanula.operators.describe import DISCOUNT_EDGES, DISCOUNT_LABELS
    got = _one(spark, [0.0, 10.0, 10.5, 20.0, 100.0, 101.0],
               lambda c: C.cut(c, DISCOUNT_EDGES, DISCOUNT_LABELS), "double")
    assert got == ["0%", "1-10%", "11-15%", "16-20%", ">20%", None]


def test_cut_priority(spark):
    from campanula.operators.evaluate import priority_tier
    got = _one(spark, [0.33, 0.330001, 0.66, 0.67], priority_tier, "double")
    assert got == ["Low", "Medium", "Medium", "High"]


def test_rfm_tier(spark):
    df = spark.createDataFrame([(5, 5, 5), (1, 4, 1), (2, 2, 5), (4, 1, 1), (3, 3, 3), (None, 3, 3)],
                               "r int, f int, m int")
    got = [r[0] for r in df.select(C.rfm_tier("r", "f", "m")).collect()]
    assert got == ["Champions", "At Risk", "Lost Causes", "New Customers", "Average", "No Orders"]


def test_engagement_score(spark):
    df = spark.createDataFrame([(True, True, 5.0, False), (False, False, None, True)],
                               "checkout_started boolean, add_to_cart boolean, pages_viewed double, bounce boolean")
    assert [r[0] for r in df.select(C.engagement_score()).collect()] == [5.5, -1.0]


def test_safe_div_and_clip(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (None, 2.0)], "a double, b double")
    out = df.select(C.safe_div("a", "b"), C.safe_div0("a", "b"), C.clip("a", 0.0, 0.75)).collect()
    assert [tuple(r) for r in out] == [(None, 0.0, 0.75), (0.5, 0.5, 0.75), (None, None, None)]


def test_dedupe_first_matches_pandas(spark):
    import numpy as np
    import pandas as pd
    from campanula.operators.tables import dedupe_first
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 50, 900).astype(object)
    keys[:300] = 7          # one id on a third of the rows
    keys[300:310] = None    # null keys
    pdf = pd.DataFrame({"k": keys, "pos": np.arange(900), "v": rng.random(900)})
    sdf = spark.createDataFrame(pdf.astype({"k": "Int64"}))
    got = dedupe_first(sdf, "k", "pos").toPandas().sort_values("pos").reset_index(drop=True)
    exp = pdf.drop_duplicates("k", keep="first").sort_values("pos").reset_index(drop=True)
    assert got.pos.tolist() == exp.pos.tolist() and np.allclose(got.v, exp.v)
