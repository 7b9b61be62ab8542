"""Evaluation (EVA-*), survival (SUR-*) and IPTW (CAU-01) queries.

The evaluated scorer is the lead score itself rescaled to [0, 1], which is
deterministic and expressible in SQL, so every evaluation operator is
checked against the oracle.  Model-based scores go through the same
operators in ``q_models`` (rows-only).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from campanula.operators import describe as D
from campanula.operators import evaluate as EV
from campanula.plans.registry import register, tables
from campanula.plans.sqlbase import cte

G = "evaluate"


def scored(t):
    return (t.leads.filter(F.col("lead_score").isNotNull())
            .select("lead_id", F.col("converted_30d").alias("label"),
                    F.least(F.greatest(F.col("lead_score") / 100.0, F.lit(0.0)), F.lit(1.0)).alias("score")))


cte("scored", """
SELECT lead_id, converted_30d AS label, least(greatest(lead_score / 100.0, 0.0), 1.0) AS score
FROM leads WHERE lead_score IS NOT NULL""")


def _dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _count_le(col: str, edges, strict: bool) -> str:
    op = "<" if strict else "<="
    return "(" + " + ".join(f"CAST({_dbl(e)} {op} {col} AS INTEGER)" for e in edges) + ")"


@register("eval_binary_metrics", """
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
  CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy,
  COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0.0) AS precision,
  COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0.0) AS recall,
  COALESCE(2 * p * r / NULLIF(p + r, 0), 0.0) AS f1
FROM (SELECT *, COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0.0) AS p,
             COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0.0) AS r
      FROM (SELECT count_if(label AND score >= 0.5) AS tp, count_if(NOT label AND score >= 0.5) AS fp,
                   count_if(label AND score < 0.5) AS fn, count_if(NOT label AND score < 0.5) AS tn FROM scored) a) b""",
          group=G)
def q_bin(spark, sf_dir):
    return EV.binary_metrics(scored(tables(spark, sf_dir)))


@register("eval_auc", """
SELECT CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg,
  (r1 - n_pos * (n_pos + 1) / 2.0) / (CAST(n_pos AS DOUBLE) * n_neg) AS auc
FROM (SELECT count_if(label) AS n_pos, count_if(NOT label) AS n_neg,
             sum(CASE WHEN label THEN rk END) AS r1
      FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk
            FROM scored) r) a""", group=G)
def q_auc(spark, sf_dir):
    return EV.auc(scored(tables(spark, sf_dir)))


@register("eval_confusion", """
SELECT CAST(label AS INTEGER) AS actual, CAST(score >= 0.5 AS INTEGER) AS predicted, count(*) AS n
FROM scored GROUP BY 1, 2""", group=G)
def q_confusion(spark, sf_dir):
    return EV.confusion(scored(tables(spark, sf_dir)))


@register("eval_roc_points", """
SELECT score AS threshold, sum(nn) OVER (ORDER BY score DESC) / (SELECT count_if(NOT label) FROM scored) AS fpr,
  sum(np) OVER (ORDER BY score DESC) / (SELECT count_if(label) FROM scored) AS tpr
FROM (SELECT score, sum(CAST(label AS INTEGER)) AS np, sum(1 - CAST(label AS INTEGER)) AS nn FROM scored GROUP BY score) g""",
          group=G)
def q_roc(spark, sf_dir):
    return EV.roc_points(scored(tables(spark, sf_dir)))


@register("eval_calibration", f"""
SELECT {_count_le('score', EV.CALIBRATION_EDGES, True)} AS bin, avg(score) AS mean_predicted,
  avg(CAST(label AS DOUBLE)) AS fraction_positive, count(*) AS n
FROM scored GROUP BY 1""", group=G)
def q_calib(spark, sf_dir):
    return EV.calibration(scored(tables(spark, sf_dir)))


_GRID = " UNION ALL ".join(f"SELECT {j} AS j, {_dbl(t)} AS threshold" for j, t in enumerate(EV.THRESHOLDS))


@register("eval_cost_threshold", f"""
WITH grid AS ({_GRID}),
h AS (SELECT {_count_le('score', EV.THRESHOLDS, False)} AS cell, sum(CAST(label AS INTEGER)) AS p,
             sum(1 - CAST(label AS INTEGER)) AS n FROM scored GROUP BY 1),
g AS (SELECT grid.j, grid.threshold, COALESCE(h.p, 0) AS p, COALESCE(h.n, 0) AS n FROM grid LEFT JOIN h ON grid.j = h.cell),
c AS (SELECT j, threshold, CAST(sum(p) OVER (ORDER BY j) AS BIGINT) AS fn,
             CAST((SELECT sum(n) FROM h) - sum(n) OVER (ORDER BY j) AS BIGINT) AS fp FROM g),
d AS (SELECT *, CAST(fn AS DOUBLE) * 20.0 + CAST(fp AS DOUBLE) * 5.0 AS cost FROM c)
SELECT threshold, fn, fp, cost, j = (SELECT j FROM d ORDER BY cost, j LIMIT 1) AS is_optimal FROM d""", group=G)
def q_cost(spark, sf_dir):
    return EV.cost_threshold(scored(tables(spark, sf_dir)))


_TIER_SQL = ("CASE WHEN score > -0.001 AND score <= 0.33 THEN 'Low' WHEN score > 0.33 AND score <= 0.66 THEN 'Medium' "
             "WHEN score > 0.66 AND score <= 1.001 THEN 'High' END")


@register("lead_scores", f"SELECT lead_id, score, {_TIER_SQL} AS priority_tier FROM scored", group=G)
def q_lead_scores(spark, sf_dir):
    s = scored(tables(spark, sf_dir))
    return s.select("lead_id", "score", EV.priority_tier(F.col("score")).alias("priority_tier"))


@register("eval_deciles", """
WITH d AS (SELECT label, CASE WHEN n <= 1 THEN 1 ELSE greatest(1, ((rn - 1) * 10 + n - 2) // (n - 1)) END AS decile
           FROM (SELECT label, row_number() OVER (ORDER BY score, lead_id) AS rn, count(*) OVER () AS n FROM scored) r),
g AS (SELECT CAST(decile AS INTEGER) AS decile, count(*) AS count, CAST(sum(CAST(label AS BIGINT)) AS BIGINT) AS conversions
      FROM d GROUP BY 1)
SELECT decile, count, conversions, CAST(conversions AS DOUBLE) / count AS conversion_rate,
  sum(conversions) OVER (ORDER BY decile DESC) / sum(count) OVER (ORDER BY decile DESC) AS cumulative_rate FROM g""",
          group=G)
def q_deciles(spark, sf_dir):
    return EV.decile_table(scored(tables(spark, sf_dir)), "lead_id")


@register("eval_tier_stats", f"""
SELECT priority_tier, n, conversions, CAST(conversions AS DOUBLE) / n AS rate,
  round(n * 100.0 / sum(n) OVER (), 1) AS share_pct
FROM (SELECT {_TIER_SQL} AS priority_tier, count(*) AS n, CAST(sum(CAST(label AS BIGINT)) AS BIGINT) AS conversions
      FROM scored GROUP BY 1) g WHERE priority_tier IS NOT NULL""", group=G)
def q_tiers(spark, sf_dir):
    return EV.tier_stats(scored(tables(spark, sf_dir)))


# --- CLV projection with a frequency model: P(repeat within 90d | first category) ---
cte("clv_base", """
SELECT a.customer_id, a.total_revenue, a.total_orders, a.total_acquisition_cost, r.product_category,
  p.prob_repeat_90d
FROM abt a JOIN repeat_target r ON a.customer_id = r.customer_id
LEFT JOIN (SELECT product_category, avg(CAST(repeat_90d AS DOUBLE)) AS prob_repeat_90d FROM repeat_target
           GROUP BY product_category) p ON r.product_category IS NOT DISTINCT FROM p.product_category""")

cte("clv_projection", """
SELECT *, prob_repeat_90d * 2 AS projected_orders_6m,
  total_revenue + total_revenue / CASE WHEN total_orders = 0 THEN 1 ELSE total_orders END * (prob_repeat_90d * 2)
    AS projected_clv_6m
FROM clv_base""")


def clv_base(t):
    rt = t.repeat_target
    prob = rt.groupBy("product_category").agg(F.avg(F.col("repeat_90d").cast("double")).alias("prob_repeat_90d"))
    base = t.abt.select("customer_id", "total_revenue", "total_orders", "total_acquisition_cost") \
        .join(rt.select("customer_id", "product_category"), "customer_id")
    return base.join(prob, base.product_category.eqNullSafe(prob.product_category), "left") \
               .drop(prob.product_category)


@register("clv_projection", "SELECT * FROM clv_projection", group=G)
def q_clv(spark, sf_dir):
    return EV.project_clv(clv_base(tables(spark, sf_dir)))


@register("loss_making_share", """
SELECT avg(CAST(total_acquisition_cost > projected_clv_6m AS DOUBLE)) AS loss_making_share, count(*) AS n
FROM clv_projection""", group=G)
def q_loss(spark, sf_dir):
    return EV.loss_making(EV.project_clv(clv_base(tables(spark, sf_dir))))


# --- IPTW with a stratified propensity: P(discount | channel) -----------------
@register("iptw_discount_ate", """
WITH b AS (SELECT CAST(COALESCE(discount_offered_pct > 0, false) AS DOUBLE) AS t, CAST(converted_30d AS DOUBLE) AS y,
                  channel FROM leads_camp WHERE channel IS NOT NULL),
p AS (SELECT channel, avg(t) AS ps FROM b GROUP BY channel),
w AS (SELECT b.t, b.y, b.t / least(greatest(p.ps, 1e-6), 1 - 1e-6)
                       + (1 - b.t) / (1 - least(greatest(p.ps, 1e-6), 1 - 1e-6)) AS w
      FROM b JOIN p ON b.channel = p.channel)
SELECT count(*) AS n, sum(t * w * y) / sum(t * w) AS treated_mean, sum((1 - t) * w * y) / sum((1 - t) * w) AS control_mean,
  sum(t * w * y) / sum(t * w) - sum((1 - t) * w * y) / sum((1 - t) * w) AS ate FROM w""", group=G)
def q_iptw(spark, sf_dir):
    t = tables(spark, sf_dir)
    b = (D.leads_with_campaign(t.leads, t.campaigns).filter(F.col("channel").isNotNull())
         .select("channel", F.coalesce(F.col("discount_offered_pct") > 0, F.lit(False)).cast("double").alias("t"),
                 F.col("converted_30d").cast("double").alias("y")))
    ps = b.groupBy("channel").agg(F.avg("t").alias("ps"))
    return EV.iptw_ate(b.join(ps, "channel"), "t", "y", "ps")


# --- balance of treated and control leads, before and after weighting by channel ---
def _balance_sql(source: str, w: str) -> str:
    def row(name, level, frame, x):
        return f"""SELECT '{name}' AS covariate, {level} AS level,
  sum(CASE WHEN t = 1 THEN {w} * {x} END) / sum(CASE WHEN t = 1 THEN {w} END) AS m1, sum(CASE WHEN t = 0 THEN {w} * {x} END) / sum(CASE WHEN t = 0 THEN {w} END) AS m0,
  sum(CASE WHEN t = 1 THEN {w} * {x} * {x} END) / sum(CASE WHEN t = 1 THEN {w} END) AS s1, sum(CASE WHEN t = 0 THEN {w} * {x} * {x} END) / sum(CASE WHEN t = 0 THEN {w} END) AS s0
FROM {frame}"""
    def by_level(c):
        frame = f"{source} f JOIN (SELECT DISTINCT COALESCE({c}, 'unknown') AS lv FROM {source}) l ON true GROUP BY lv"
        return row(c, "lv", frame, f"CAST(COALESCE({c}, 'unknown') = lv AS DOUBLE)")
    rows = " UNION ALL ".join([row("lead_score", "CAST(NULL AS VARCHAR)", source, "score"), by_level("observed_region"), by_level("lead_source")])
    return f"""SELECT covariate, level, m1 AS treated_mean, m0 AS control_mean,
  (m1 - m0) / nullif(sqrt(greatest((s1 - m1 * m1 + s0 - m0 * m0) / 2, 0.0)), 0.0) AS std_diff FROM ({rows}) r"""


cte("treatment_frame", f"""
SELECT lead_id, CAST(COALESCE(discount_offered_pct > 0, false) AS DOUBLE) AS t, observed_region, lead_source, channel,
  COALESCE(lead_score, (SELECT quantile_cont(lead_score, 0.5) FROM leads)) AS score FROM leads_camp WHERE channel IS NOT NULL""")
cte("treatment_weighted", """
SELECT f.*, t / least(greatest(ps, 1e-6), 1 - 1e-6) + (1 - t) / (1 - least(greatest(ps, 1e-6), 1 - 1e-6)) AS w
FROM treatment_frame f JOIN (SELECT channel, avg(t) AS ps FROM treatment_frame GROUP BY channel) p ON f.channel = p.channel""")


def treatment_frame(t):
    """Leads with a channel: treated (any discount), score with the median of all leads for the missing ones (CLN-16)."""
    from campanula.functions.clean import fill_median
    leads = fill_median(t.leads, ["lead_score"])
    return (D.leads_with_campaign(leads, t.campaigns).filter(F.col("channel").isNotNull())
            .select("channel", "lead_source", "observed_region", "lead_score",
                    F.coalesce(F.col("discount_offered_pct") > 0, F.lit(False)).cast("double").alias("t")))


@register("discount_balance", _balance_sql("treatment_frame", "1.0"), group=G)
def q_balance(spark, sf_dir):
    """CAU-01: covariates of discounted and other leads before weighting."""
    return EV.covariate_balance(treatment_frame(tables(spark, sf_dir)), "t", ["lead_score"], ["observed_region", "lead_source"])


@register("discount_balance_weighted", _balance_sql("treatment_weighted", "w"), group=G)
def q_balance_weighted(spark, sf_dir):
    """CAU-01: the same after inverse-propensity weights of the stratified model."""
    b = treatment_frame(tables(spark, sf_dir))
    ps = F.least(F.greatest(F.col("ps"), F.lit(1e-6)), F.lit(1 - 1e-6))
    weighted = (b.join(b.groupBy("channel").agg(F.avg("t").alias("ps")), "channel")
                .withColumn("w", F.col("t") / ps + (1 - F.col("t")) / (1 - ps)))
    return EV.covariate_balance(weighted, "t", ["lead_score"], ["observed_region", "lead_source"], "w")


# --- the encodings of a conversion flag and what both truth sets make of them ---
@register("conversion_flag_encodings", """
SELECT raw, n, COALESCE(lower(trim(raw)) IN ('yes', 'true', '1', '1.0'), false) AS strict,
  CASE WHEN lower(trim(raw)) IN ('1', 'true', 'yes', 'y', 't') THEN 1 ELSE COALESCE(TRY_CAST(trunc(TRY_CAST(trim(raw) AS DOUBLE)) AS BIGINT), 0) END AS flag
FROM (SELECT converted_30d AS raw, count(*) AS n FROM b_leads GROUP BY converted_30d) x""", group="audit")
def q_flag_encodings(spark, sf_dir):
    """CLN-05/06: every raw spelling of ``converted_30d`` with its count, the strict and the wide reading."""
    from campanula.functions import clean as C
    raw = tables(spark, sf_dir).bronze_table("leads").groupBy(F.col("converted_30d").alias("raw")).agg(F.count(F.lit(1)).alias("n"))
    return raw.select("raw", "n", C.parse_bool("raw").alias("strict"), C.parse_flag("raw").alias("flag"))


# --- Kaplan-Meier: time from first to second order, censored at the last order date ---
cte("km_input", """
SELECT r.customer_id, a.loyalty_tier,
  date_diff('day', r.first_order_date, COALESCE(r.second_order_date, (SELECT max(order_date) FROM transactions))) AS t,
  CAST(r.second_order_date IS NOT NULL AS INTEGER) AS e
FROM repeat_target r JOIN abt a ON r.customer_id = a.customer_id WHERE r.first_order_date IS NOT NULL""")


def km_input(t):
    rt = t.repeat_target.filter(F.col("first_order_date").isNotNull())
    end = F.coalesce(F.col("second_order_date"),
                     t.transactions.select(F.max("order_date")).scalar())
    return (rt.join(t.abt.select("customer_id", "loyalty_tier"), "customer_id")
            .select("customer_id", "loyalty_tier",
                    F.datediff(end, F.col("first_order_date")).cast("bigint").alias("t"),
                    F.col("second_order_date").isNotNull().cast("int").alias("e")))


_KM_SQL = """
SELECT {keys}t AS time, CAST(n_at_risk AS BIGINT) AS n_at_risk, CAST(events AS BIGINT) AS events,
  CAST(m - events AS BIGINT) AS censored,
  CASE WHEN sum(CASE WHEN events >= n_at_risk THEN 1 ELSE 0 END) OVER w > 0 THEN 0.0
       ELSE exp(sum(CASE WHEN events < n_at_risk THEN ln(1 - events / n_at_risk) ELSE 0.0 END) OVER w) END AS survival
FROM (SELECT *, sum(m) OVER ({part}) - (sum(m) OVER ({part_order}) - m) AS n_at_risk FROM (
        SELECT {keys}t, CAST(sum(e) AS DOUBLE) AS events, count(*) AS m FROM km_input {where} GROUP BY {keys}t) a) b
WINDOW w AS ({part_order})"""


@register("km_table", _KM_SQL.format(keys="", part="", part_order="ORDER BY t", where=""), group=G)
def q_km(spark, sf_dir):
    return EV.kaplan_meier(km_input(tables(spark, sf_dir)), "t", "e")


@register("km_summary", """
SELECT CAST(sum(events + censored) AS BIGINT) AS n, CAST(sum(events) AS BIGINT) AS n_events,
  min(CASE WHEN survival <= 0.5 THEN time END) AS median_time FROM km_table_sql""", group=G)
def q_km_summary(spark, sf_dir):
    return EV.km_summary(EV.kaplan_meier(km_input(tables(spark, sf_dir)), "t", "e"))


cte("km_table_sql", _KM_SQL.format(keys="", part="", part_order="ORDER BY t", where=""))


@register("km_by_loyalty_tier", _KM_SQL.format(
    keys="loyalty_tier, ", part="PARTITION BY loyalty_tier", part_order="PARTITION BY loyalty_tier ORDER BY t",
    where="WHERE loyalty_tier IN (SELECT loyalty_tier FROM km_input GROUP BY loyalty_tier HAVING count(*) >= 20)"),
    group=G)
def q_km_tier(spark, sf_dir):
    k = km_input(tables(spark, sf_dir)).filter(F.col("loyalty_tier").isNotNull())
    big = k.groupBy("loyalty_tier").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= 20).select("loyalty_tier")
    return EV.kaplan_meier(k.join(big, "loyalty_tier", "left_semi"), "t", "e", by="loyalty_tier")


# --- EVA-12: early-warning comparison of repeaters vs non-repeaters ----------
WARNING_FEATURES = ("total_acquisition_cost", "total_revenue", "total_sessions", "age")

cte("ew_base", """
SELECT a.*, r.repeat_90d FROM abt a JOIN repeat_target r ON a.customer_id = r.customer_id""")


def ew_base(t):
    rt = t.repeat_target.select("customer_id", "repeat_90d")
    return t.abt.join(rt, "customer_id")


def ew_long(t):
    """(repeat_90d, feature, v): each value cut at its feature's p98; staged."""
    def build():
        from campanula.functions import clean as C
        from campanula.operators import ranks as RK
        base = ew_base(t).select("repeat_90d", *[F.col(f).cast("double").alias(f) for f in WARNING_FEATURES])
        long = t.stage("early_warning", lambda: base.unpivot(["repeat_90d"], list(WARNING_FEATURES), "feature", "x"))
        tops = RK.exact_quantiles(long, "x", {"top": 0.98}, ["feature"])  # one row per feature
        return long.join(F.broadcast(tops), "feature", "left").select(
            "repeat_90d", "feature", C.clip(F.col("x"), None, F.col("top")).alias("v"))
    return t.stage("early_warning_clipped", build)


def _ew_src(f):
    return (f"SELECT repeat_90d = 1 AS x, CASE WHEN {f} IS NULL THEN NULL ELSE least(CAST({f} AS DOUBLE), "
            f"(SELECT quantile_cont(CAST({f} AS DOUBLE), 0.98) FROM ew_base)) END AS v FROM ew_base")


def _ew_sql():
    from campanula.plans.q_stats import _mw_sql
    return " UNION ALL ".join(_mw_sql(f, _ew_src(f)) for f in WARNING_FEATURES)


@register("early_warning_tests", _ew_sql(), group=G)
def q_early_warning(spark, sf_dir):
    from campanula.operators import stats as S
    long = ew_long(tables(spark, sf_dir))
    return S.union_all([S.mann_whitney(long.filter(F.col("feature") == f), F.col("repeat_90d") == 1, "v", f)
                        for f in WARNING_FEATURES])


def _ew_hist_sql():
    parts = []
    for f in WARNING_FEATURES:
        for g in (0, 1):
            src = f"SELECT v FROM ({_ew_src(f)}) s WHERE x = {'true' if g else 'false'} AND v IS NOT NULL"
            lo = f"(SELECT min(v) FROM ({src}) s1)"
            w = f"(SELECT (max(v) - min(v)) / 25 FROM ({src}) s3)"
            parts.append(f"""SELECT '{f}' AS feature, {g} AS repeat_90d, g.range AS bin,
  {lo} + g.range * {w} AS lo, {lo} + (g.range + 1) * {w} AS hi, COALESCE(c.n, 0) AS n
FROM range(25) g
LEFT JOIN (SELECT CAST(CASE WHEN {w} > 0 THEN least(floor((s2.v - {lo}) / {w}), 24) ELSE 0 END AS BIGINT) AS bin,
                  count(*) AS n
           FROM ({src}) s2 GROUP BY 1) c
ON g.range = c.bin""")
    return " UNION ALL ".join(parts)


@register("early_warning_histograms", _ew_hist_sql(), group=G)
def q_early_hist(spark, sf_dir):
    from campanula.operators.describe import histograms
    out = histograms(ew_long(tables(spark, sf_dir)), ["feature", "repeat_90d"], "v", 25)
    return out.select("feature", F.col("repeat_90d").cast("int").alias("repeat_90d"), "bin", "lo", "hi", "n")
