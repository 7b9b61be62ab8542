"""Flags, id lists in blocks and covariate balance against plain versions."""

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from campanula.functions import clean as C
from campanula.operators import describe as D
from campanula.operators import evaluate as EV


def test_wide_flags(spark):
    want = {"Y": 1, " t ": 1, "Yes": 1, "TRUE": 1, "1": 1, "1.0": 1, "0": 0, "0.9": 0, "2": 2, "2.7": 2, "-1.5": -1, "no": 0, "": 0, "1e400": 0, "nan": 0}
    df = spark.createDataFrame([(k,) for k in want] + [(None,)], "v string")
    got = {r.v: r.f for r in df.select("v", C.parse_flag("v").alias("f")).collect()}
    assert got == want | {None: 0}


def test_id_blocks_are_the_whole_list(spark):
    ids = [f"c{k:04d}" for k in range(1037)]
    df = spark.createDataFrame([(i,) for i in random.Random(1).sample(ids, len(ids))] + [("c0005",), (None,)], "id string")
    rows = D.id_list_blocks(df, "id", 100).orderBy("block").collect()
    assert [r.block for r in rows] == list(range(11)) and [r.n for r in rows] == [100] * 10 + [37]
    assert ", ".join(r.ids for r in rows) == ", ".join(ids) and rows[3].first_id == "c0300" and rows[3].last_id == "c0399"
    assert D.id_list_blocks(df.filter("1 = 0"), "id").count() == 0


def _plain(pdf, x, w):
    out = []
    for side in (1.0, 0.0):
        s = pdf[(pdf.t == side) & pdf[x].notna()]
        if not len(s):
            return None, None, None
        m = np.average(s[x], weights=s[w])
        out.append((m, np.average((s[x] - m) ** 2, weights=s[w])))
    sd = math.sqrt((out[0][1] + out[1][1]) / 2)
    return out[0][0], out[1][0], (out[0][0] - out[1][0]) / sd if sd > 1e-9 else None


def test_balance_against_plain_formulas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"t": (rng.random(900) < 0.3).astype(float), "x": rng.normal(size=900), "w": rng.random(900) + 0.1,
                        "g": rng.choice(["a", "b", None], 900), "h": ["same"] * 900})
    pdf.loc[pdf.t == 1, "g"] = pdf.g[pdf.t == 1].where(pdf.g[pdf.t == 1] != "b", "a")  # no treated row has level b
    pdf.loc[::50, "x"] = np.nan
    df = spark.createDataFrame(pdf.astype({"g": object}).where(pdf.notna(), None)).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    pdf["g"] = pdf.g.fillna("unknown")
    for weight in (None, "w"):
        w = weight or "one"
        pdf["one"] = 1.0
        got = {(r.covariate, r.level): r for r in EV.covariate_balance(df, "t", ["x"], ["g", "h"], weight).collect()}
        assert set(got) == {("x", None), ("g", "a"), ("g", "b"), ("g", "unknown"), ("h", "same")}
        for (c, level), r in got.items():
            frame = pdf if level is None else pdf.assign(**{f"is_{level}": (pdf[c] == level).astype(float)})
            m1, m0, d = _plain(frame, c if level is None else f"is_{level}", w)
            assert math.isclose(r.treated_mean, m1, abs_tol=1e-9) and math.isclose(r.control_mean, m0, abs_tol=1e-9)
            assert (r.std_diff is None) == (d is None) and (d is None or math.isclose(r.std_diff, d, rel_tol=1e-6)), (c, level)


def test_balance_with_one_group_or_no_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (1.0, 3.0, None)], "t double, x double, g string")
    rows = EV.covariate_balance(df, "t", ["x"], ["g"]).collect()
    assert len(rows) == 3 and all(r.std_diff is None and r.control_mean is None for r in rows)
    assert EV.covariate_balance(df.filter("1 = 0"), "t", ["x"], ["g"]).count() == 0
