"""Tier-P queries (promised in the reference's plan, never computed there)."""

from __future__ import annotations

from pyspark.sql import functions as F

from campanula.operators import cube as CU
from campanula.operators import describe as D
from campanula.operators import evaluate as EV
from campanula.operators import extended as X
from campanula.plans.q_stats import p_sql
from campanula.plans.registry import register, tables
from campanula.plans.sqlbase import cte

G = "promised"


@register("linear_attribution", """
SELECT s.channel_group AS channel, sum(c.rev / c.n) AS linear_revenue, count(*) AS sessions
FROM sessions s JOIN (
  SELECT p.customer_id, r.rev, p.n FROM
    (SELECT customer_id, count(*) AS n FROM sessions WHERE customer_id IS NOT NULL GROUP BY customer_id) p
    JOIN (SELECT customer_id, sum(revenue_usd) AS rev FROM transactions WHERE customer_id IS NOT NULL
          GROUP BY customer_id) r ON p.customer_id = r.customer_id) c ON s.customer_id = c.customer_id
WHERE s.channel_group IS NOT NULL GROUP BY s.channel_group""", group=G)
def q_linear(spark, sf_dir):
    t = tables(spark, sf_dir)
    return X.linear_attribution(t.sessions, t.transactions)


@register("pareto_frontier", """
SELECT campaign_id, channel, spend_usd, roas AS "ROAS",
  COALESCE(roas > mb, mb IS NULL) AS on_frontier
FROM (SELECT campaign_id, channel, spend_usd, COALESCE("ROAS", 0.0) AS roas,
        max(COALESCE("ROAS", 0.0)) OVER (ORDER BY spend_usd, COALESCE("ROAS", 0.0) DESC, campaign_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mb
      FROM camp_features WHERE spend_usd IS NOT NULL) t""", group=G)
def q_pareto(spark, sf_dir):
    from campanula.plans.q_campaign import features
    return X.pareto_frontier(features(tables(spark, sf_dir)))


@register("campaign_lifecycle", """
SELECT campaign_id, weeks, CASE WHEN weeks >= 3 THEN slope END AS slope,
  COALESCE(weeks >= 3 AND slope < 0, false) AS decay, COALESCE(weeks >= 3 AND slope > 0, false) AS ramp_up
FROM (SELECT campaign_id, count(*) AS weeks, covar_pop(rate, week) / NULLIF(var_pop(CAST(week AS DOUBLE)), 0) AS slope
      FROM (SELECT l.campaign_id, CAST(floor(date_diff('day', c.start_date, l.lead_date) / 7) AS BIGINT) AS week,
                   avg(CAST(l.converted_30d AS DOUBLE)) AS rate
            FROM leads l JOIN campaigns c ON l.campaign_id = c.campaign_id
            WHERE l.lead_date IS NOT NULL AND c.start_date IS NOT NULL
              AND floor(date_diff('day', c.start_date, l.lead_date) / 7) >= 0
            GROUP BY 1, 2) w GROUP BY campaign_id) g""", group=G)
def q_lifecycle(spark, sf_dir):
    t = tables(spark, sf_dir)
    return X.campaign_lifecycle(t.leads, t.campaigns)


@register("engagement_funnel", """
SELECT step, stage, CAST(customers AS BIGINT) AS customers FROM (
  SELECT 1 AS step, 'sessions' AS stage, count(DISTINCT customer_id) AS customers FROM sessions WHERE customer_id IS NOT NULL
  UNION ALL SELECT 2, 'add_to_cart', count(DISTINCT CASE WHEN add_to_cart THEN customer_id END) FROM sessions
            WHERE customer_id IS NOT NULL
  UNION ALL SELECT 3, 'checkout', count(DISTINCT CASE WHEN checkout_started THEN customer_id END) FROM sessions
            WHERE customer_id IS NOT NULL
  UNION ALL SELECT 4, 'converted_lead', count(DISTINCT customer_id) FROM leads WHERE converted_30d
  UNION ALL SELECT 5, 'purchased', count(DISTINCT customer_id) FROM transactions) u""", group=G)
def q_funnel(spark, sf_dir):
    t = tables(spark, sf_dir)
    return X.engagement_funnel(t.sessions, t.leads, t.transactions)


_UPLIFT = """
SELECT {key}, no_discount, discounted_lcr, (discounted_lcr - no_discount) * 100 AS uplift_pp FROM (
  SELECT {key}, avg(CASE WHEN NOT t THEN y END) AS no_discount, avg(CASE WHEN t THEN y END) AS discounted_lcr
  FROM (SELECT {key}, COALESCE(discount_offered_pct > 0, false) AS t, CAST(converted_30d AS DOUBLE) AS y FROM {src}) s
  WHERE {key} IS NOT NULL GROUP BY {key}) g
WHERE no_discount IS NOT NULL AND discounted_lcr IS NOT NULL"""

for _key, _src in (("objective", "leads_camp"), ("landing_page", "leads"),
                   ("region", "(SELECT l.*, a.region FROM leads l LEFT JOIN abt a ON l.customer_id = a.customer_id) r")):
    def _mk(key):
        def run(spark, sf_dir):
            t = tables(spark, sf_dir)
            if key == "objective":
                df = D.leads_with_campaign(t.leads, t.campaigns)
            elif key == "region":
                df = D.lookup(t.leads, t.abt, "customer_id", ["region"])
            else:
                df = t.leads
            return D.uplift_by(df, key, F.col("discount_offered_pct") > 0, "converted_30d")
        return run
    register(f"uplift_by_{_key}", _UPLIFT.format(key=_key, src=_src), group=G)(_mk(_key))


for _key in ("income_band", "city"):
    register(f"value_by_{_key}", f"""
SELECT {_key}, count(customer_id) AS customers, avg(total_revenue) AS avg_revenue,
  sum(total_revenue) AS total_revenue, avg("LCR") AS avg_lcr
FROM abt WHERE {_key} IS NOT NULL GROUP BY {_key}""", group=G)(
        (lambda key: lambda spark, sf_dir: D.value_by(tables(spark, sf_dir).abt, key,
                                                       {"avg_lcr": F.avg("LCR")}))(_key))


@register("outlier_impact", """
SELECT CAST(count_if(f) AS BIGINT) AS n_flagged, avg("ROAS") AS mean_roas_all,
  avg(CASE WHEN NOT f THEN "ROAS" END) AS mean_roas_clean, sum(spend_usd) AS total_spend_all,
  sum(CASE WHEN NOT f THEN spend_usd END) AS total_spend_clean, avg("LCR") AS mean_lcr_all,
  avg(CASE WHEN NOT f THEN "LCR" END) AS mean_lcr_clean
FROM (SELECT *, COALESCE(spend_usd < 0 OR spend_usd > (SELECT quantile_cont(spend_usd, 0.99) FROM camp_features), false) AS f
      FROM camp_features) t""", group=G)
def q_outlier(spark, sf_dir):
    from campanula.plans.q_campaign import features
    return X.outlier_impact(features(tables(spark, sf_dir)))


@register("rfm_x_acquisition_channel", """
SELECT r."RFM_Tier", COALESCE(c.acquisition_channel, '(unattributed)') AS acquisition_channel, count(*) AS n
FROM rfm r LEFT JOIN acq_channel c ON r.customer_id = c.customer_id GROUP BY 1, 2""", group=G)
def q_rfm_x_ch(spark, sf_dir):
    t = tables(spark, sf_dir)
    j = D.rfm_scores(t.abt).join(D.acquisition_channel(t.leads, t.campaigns), "customer_id", "left") \
         .na.fill({"acquisition_channel": "(unattributed)"})
    return D.crosstab(j, "RFM_Tier", "acquisition_channel")


@register("revenue_at_risk", """
SELECT count(*) AS tier_customers, CAST(count_if(NOT a.email_opt_in) AS BIGINT) AS not_opted_in,
  COALESCE(sum(CASE WHEN NOT a.email_opt_in THEN a.total_revenue END), 0.0) AS revenue_at_risk,
  COALESCE(sum(a.total_revenue), 0.0) AS tier_revenue
FROM rfm r JOIN abt a ON r.customer_id = a.customer_id WHERE r."RFM_Tier" = 'Champions'""", group=G)
def q_risk(spark, sf_dir):
    t = tables(spark, sf_dir)
    return X.revenue_at_risk(D.rfm_scores(t.abt), t.abt)


@register("campaign_efficiency", """
SELECT campaign_id, channel, CAST(clicks AS DOUBLE) / NULLIF(CAST(impressions AS DOUBLE), 0) AS ctr,
  "ROAS" / NULLIF(spend_usd / NULLIF(budget_usd, 0), 0) AS budget_efficiency
FROM camp_features""", group=G)
def q_ctr(spark, sf_dir):
    from campanula.plans.q_campaign import features
    return X.campaign_efficiency(features(tables(spark, sf_dir)))


@register("gateway_repeat_90d", """
SELECT product_category, count(*) AS customers, avg(CAST(repeat_90d AS DOUBLE)) AS repeat_90d_rate
FROM repeat_target WHERE product_category IS NOT NULL GROUP BY product_category""", group=G)
def q_gateway90(spark, sf_dir):
    rt = tables(spark, sf_dir).repeat_target
    return rt.filter(F.col("product_category").isNotNull()).groupBy("product_category").agg(
        F.count(F.lit(1)).alias("customers"), F.avg(F.col("repeat_90d").cast("double")).alias("repeat_90d_rate"))


@register("top_decile_clv_outside_top_tier", """
SELECT count(*) AS top_decile_customers,
  CAST(count_if(COALESCE(a.loyalty_tier <> 'platinum', true)) AS BIGINT) AS outside_top_tier
FROM (SELECT customer_id, CASE WHEN n <= 1 THEN 1 ELSE greatest(1, ((rn - 1) * 10 + n - 2) // (n - 1)) END AS decile
      FROM (SELECT customer_id, row_number() OVER (ORDER BY projected_clv_6m, customer_id) AS rn,
                   count(projected_clv_6m) OVER () AS n FROM clv_projection WHERE projected_clv_6m IS NOT NULL) r) d
JOIN abt a ON d.customer_id = a.customer_id WHERE d.decile = 10""", group=G)
def q_top_decile(spark, sf_dir):
    from campanula.plans.q_eval import clv_base
    t = tables(spark, sf_dir)
    return X.top_decile_outside_top_tier(EV.project_clv(clv_base(t)), t.abt)


@register("loss_making_by_channel", """
SELECT acquisition_channel, count(*) AS customers,
  CAST(count_if(total_acquisition_cost > projected_clv_6m) AS BIGINT) AS loss_making,
  avg(CAST(total_acquisition_cost > projected_clv_6m AS DOUBLE)) AS loss_share,
  COALESCE(sum(CASE WHEN total_acquisition_cost > projected_clv_6m THEN total_acquisition_cost END), 0.0) AS loss_spend
FROM (SELECT p.*, COALESCE(c.acquisition_channel, '(unattributed)') AS acquisition_channel
      FROM clv_projection p LEFT JOIN acq_channel c ON p.customer_id = c.customer_id) t
GROUP BY acquisition_channel""", group=G)
def q_loss_channel(spark, sf_dir):
    from campanula.plans.q_eval import clv_base
    t = tables(spark, sf_dir)
    return X.loss_making_by_channel(EV.project_clv(clv_base(t)), D.acquisition_channel(t.leads, t.campaigns))


@register("landing_page_ranking", """
WITH lp AS (SELECT l.landing_page, count(l.lead_id) AS n_leads, avg(CAST(l.converted_30d AS DOUBLE)) AS lcr,
                   avg(a."AOV") AS avg_customer_aov
            FROM leads l LEFT JOIN abt a ON l.customer_id = a.customer_id
            WHERE l.landing_page IS NOT NULL GROUP BY l.landing_page),
b AS (SELECT l.landing_page, avg(CAST(s.bounce AS DOUBLE)) AS bounce_rate
      FROM sessions s JOIN leads l ON s.customer_id = l.customer_id WHERE l.landing_page IS NOT NULL
      GROUP BY l.landing_page)
SELECT lp.*, b.bounce_rate,
  rank() OVER (ORDER BY lcr DESC) AS rank_lcr,
  rank() OVER (ORDER BY avg_customer_aov DESC NULLS LAST) AS rank_aov,
  rank() OVER (ORDER BY b.bounce_rate ASC NULLS LAST) AS rank_bounce
FROM lp LEFT JOIN b ON lp.landing_page = b.landing_page""", group=G)
def q_lp_rank(spark, sf_dir):
    t = tables(spark, sf_dir)
    return X.landing_page_ranking(t.leads, t.abt, D.landing_perf(t.sessions, t.leads))


_PAIR_TESTS = """SELECT a.channel AS group_1, b.channel AS group_2, a.m - b.m AS mean_diff, (a.m - b.m) / NULLIF(sqrt(a.e + b.e), 0) AS t,
  (a.e + b.e) * (a.e + b.e) / NULLIF(a.e * a.e / (a.n - 1) + b.e * b.e / (b.n - 1), 0) AS df
FROM (SELECT channel, count(*) AS n, avg(cust_aov) AS m, var_samp(cust_aov) / count(*) AS e FROM aov_last_touch
      WHERE channel IS NOT NULL AND cust_aov IS NOT NULL GROUP BY channel HAVING count(*) > 1) a
JOIN (SELECT channel, count(*) AS n, avg(cust_aov) AS m, var_samp(cust_aov) / count(*) AS e FROM aov_last_touch
      WHERE channel IS NOT NULL AND cust_aov IS NOT NULL GROUP BY channel HAVING count(*) > 1) b ON a.channel < b.channel"""


@register("pairwise_welch_aov_by_channel", f"""
SELECT group_1, group_2, mean_diff, t, df, p_value, p_holm, p_holm < 0.05 AS significant
FROM (SELECT *, max(least(1.0, (m - i + 1) * p_value)) OVER (ORDER BY i) AS p_holm
      FROM (SELECT w.*, p.p_value, row_number() OVER (ORDER BY p.p_value, w.group_1, w.group_2) AS i, count(*) OVER () AS m
            FROM ({_PAIR_TESTS}) w
            JOIN ({p_sql(f"SELECT group_1 || '|' || group_2 AS test, t AS statistic, t AS p_stat, 0 AS n, 't2' AS dist, df AS df1, CAST(NULL AS DOUBLE) AS df2 FROM ({_PAIR_TESTS}) v")}) p
              ON p.test = w.group_1 || '|' || w.group_2) x) y""", group=G)
def q_pairwise(spark, sf_dir):
    from campanula.plans.q_describe import aov_last_touch
    return X.pairwise_welch_holm(aov_last_touch(tables(spark, sf_dir)), "channel", "cust_aov")


@register("kpi_by_region", """
SELECT region, total_leads, conversions, lcr, revenue, aov,
  CASE WHEN lcr >= o THEN 'green' WHEN lcr >= o * 0.9 THEN 'amber' ELSE 'red' END AS band
FROM (SELECT region, CAST(sum(total_leads) AS BIGINT) AS total_leads, CAST(sum(converted_leads) AS BIGINT) AS conversions,
        CAST(sum(converted_leads) AS DOUBLE) / NULLIF(sum(total_leads), 0) AS lcr, sum(total_revenue) AS revenue,
        sum(total_revenue) / NULLIF(sum(total_orders), 0) AS aov,
        (SELECT CAST(sum(converted_leads) AS DOUBLE) / NULLIF(sum(total_leads), 0) FROM abt) AS o
      FROM abt WHERE region IS NOT NULL GROUP BY region) g""", group=G)
def q_kpi_region(spark, sf_dir):
    return X.kpi_slices(tables(spark, sf_dir).abt, "region")


# rows of all facts with their own measures; one cube over all of them
cte("kpi_rows", """
SELECT COALESCE(strftime(l.lead_date, '%Y-%m'), 'Unknown') AS month, COALESCE(c.channel, 'Unknown') AS channel,
  COALESCE(l.observed_region, 'Unknown') AS region, 1 AS leads, CAST(COALESCE(l.converted_30d, false) AS INTEGER) AS conversions,
  COALESCE(l.acquisition_cost_usd, 0.0) AS acquisition_cost, 0 AS sessions, 0 AS checkouts, 0 AS orders, 0.0 AS units, 0.0 AS revenue, 0 AS returns
FROM leads l LEFT JOIN campaigns c ON l.campaign_id = c.campaign_id
UNION ALL
SELECT COALESCE(strftime(session_date, '%Y-%m'), 'Unknown'), COALESCE(channel_group, 'Unknown'), COALESCE(geo_region, 'Unknown'),
  0, 0, 0.0, 1, CAST(COALESCE(checkout_started, false) AS INTEGER), 0, 0.0, 0.0, 0 FROM sessions
UNION ALL
SELECT COALESCE(strftime(t.order_date, '%Y-%m'), 'Unknown'), COALESCE(t.marketing_channel_last_touch, 'Unknown'), COALESCE(c.region, 'Unknown'),
  0, 0, 0.0, 0, 0, 1, COALESCE(t.units, 0.0), COALESCE(t.revenue_usd, 0.0), CAST(COALESCE(t.returned_flag, false) AS INTEGER)
FROM transactions t LEFT JOIN customers c ON t.customer_id = c.customer_id""")


@register("kpi_cube", """
SELECT month, channel, region, level, leads, conversions, acquisition_cost, sessions, checkouts, orders, units, revenue, returns,
  lcr, lcr / NULLIF(o, 0) AS lift, acquisition_cost / NULLIF(leads, 0) AS cost_per_lead, revenue / NULLIF(orders, 0) AS aov,
  CAST(checkouts AS DOUBLE) / NULLIF(sessions, 0) AS checkout_rate, CAST(returns AS DOUBLE) / NULLIF(orders, 0) AS return_rate,
  CASE WHEN lcr >= o THEN 'green' WHEN lcr >= o * 0.9 THEN 'amber' WHEN lcr IS NOT NULL THEN 'red' END AS band
FROM (SELECT CASE WHEN grouping(month) = 1 THEN 'all' ELSE month END AS month, CASE WHEN grouping(channel) = 1 THEN 'all' ELSE channel END AS channel,
        CASE WHEN grouping(region) = 1 THEN 'all' ELSE region END AS region,
        CAST(4 * grouping(month) + 2 * grouping(channel) + grouping(region) AS INTEGER) AS level,
        CAST(sum(leads) AS BIGINT) AS leads, CAST(sum(conversions) AS BIGINT) AS conversions, CAST(sum(acquisition_cost) AS DOUBLE) AS acquisition_cost,
        CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(checkouts) AS BIGINT) AS checkouts, CAST(sum(orders) AS BIGINT) AS orders,
        CAST(sum(units) AS DOUBLE) AS units, CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(returns) AS BIGINT) AS returns,
        CAST(sum(conversions) AS DOUBLE) / NULLIF(sum(leads), 0) AS lcr,
        (SELECT CAST(sum(conversions) AS DOUBLE) / NULLIF(sum(leads), 0) FROM kpi_rows) AS o
      FROM kpi_rows GROUP BY CUBE (month, channel, region)) g""", group=G)
def q_kpi_cube(spark, sf_dir):
    """P-20: KPIs of every month, channel and region, alone and together."""
    t = tables(spark, sf_dir)
    if not hasattr(t, "_kpi_cells"):
        from campanula.session import materialize
        t._kpi_cells = materialize(CU.kpi_cells(t.leads, t.sessions, t.transactions, t.campaigns, t.customers))
    return CU.kpi_cube(t._kpi_cells)


_CORR_COLS = ("avg_pages_viewed", "avg_time_on_site", "total_add_to_cart", "total_checkout_started",
              "avg_engagement_score", "total_sessions")


def _corr_sql():
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for b in _CORR_COLS[i + 1:]:
            parts.append(f"SELECT '{a}' AS x, '{b}' AS y, covar_samp({a}, {b}) / "
                         f"NULLIF(stddev_samp({a}) * stddev_samp({b}), 0) AS r FROM abt")
    return " UNION ALL ".join(parts)


@register("engagement_correlations", _corr_sql(), group=G)
def q_corr(spark, sf_dir):
    return X.correlation_matrix(tables(spark, sf_dir).abt, _CORR_COLS)


# the fit by its definition: the greatest over starts of the least over ends of the mean label
cte("isotonic_cells", """
SELECT score, row_number() OVER (ORDER BY score) AS i, sum(n) OVER (ORDER BY score) AS cn, sum(s) OVER (ORDER BY score) AS cs, n, s
FROM (SELECT score, count(*) AS n, count_if(label) AS s FROM scored GROUP BY score) c""")
cte("isotonic_fit", """
SELECT score, n, max(least_mean) AS value FROM (
  SELECT x.score, x.n, a.i AS j, min(CAST(z.cs - a.cs + a.s AS DOUBLE) / (z.cn - a.cn + a.n)) AS least_mean
  FROM isotonic_cells x JOIN isotonic_cells a ON a.i <= x.i JOIN isotonic_cells z ON z.i >= x.i GROUP BY x.score, x.n, a.i) m
GROUP BY score, n""")


@register("isotonic_blocks", """
SELECT min(score) AS lo, max(score) AS hi, CAST(sum(n) AS DOUBLE) AS weight, value FROM isotonic_fit GROUP BY value""", group=G)
def q_isotonic(spark, sf_dir):
    """P-12: the steps that recalibrate the lead score, from all scored leads."""
    from campanula.operators import isotonic as IS
    from campanula.plans.q_eval import scored
    return IS.fit(scored(tables(spark, sf_dir)))


@register("isotonic_lead_scores", """
SELECT s.lead_id, s.label, s.score, f.value AS calibrated FROM scored s JOIN isotonic_fit f ON s.score = f.score""", group=G)
def q_isotonic_scores(spark, sf_dir):
    """P-12: every scored lead with its recalibrated probability."""
    from campanula.operators import isotonic as IS
    from campanula.plans.q_eval import scored
    s = scored(tables(spark, sf_dir))
    return IS.apply(s, IS.fit(s))


@register("recalibration", None, group=G)
def q_recal(spark, sf_dir):
    """P-12: Platt and isotonic recalibration of the lead score (fitted on a
    75% split, evaluated by calibration bins on the 25% holdout)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from campanula.operators import isotonic as IS
    from campanula.operators import ml as M
    from campanula.plans.q_eval import scored
    s = scored(tables(spark, sf_dir)).withColumn("label", F.col("label").cast("double"))
    train, test = M.stratified_split(s, "label", "lead_id")
    va = VectorAssembler(inputCols=["score"], outputCol="f")
    platt = LogisticRegression(featuresCol="f", labelCol="label").fit(va.transform(train))
    t = platt.transform(va.transform(test)).withColumn("p_platt", vector_to_array("probability")[1]) \
             .drop("rawPrediction", "probability", "prediction")
    t = IS.apply(t, IS.fit(train), out="p_isotonic")
    out = None
    for name, col in (("raw", "score"), ("platt", "p_platt"), ("isotonic", "p_isotonic")):
        c = EV.calibration(t.select("label", F.col(col).alias("score"))).withColumn("method", F.lit(name))
        out = c if out is None else out.unionByName(c)
    return out


@register("alternative_clustering", None, group=G)
def q_alt_cluster(spark, sf_dir):
    """P-13: bisecting k-means and a Gaussian mixture next to k-means (k=4)."""
    from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from campanula.operators import ml as M
    from campanula.session import materialize
    x = materialize(M.segment_matrix(tables(spark, sf_dir).abt))
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction", distanceMeasure="squaredEuclidean")
    rows = []
    for name, est in (("kmeans", KMeans(k=4, seed=M.SEED)), ("bisecting_kmeans", BisectingKMeans(k=4, seed=M.SEED)),
                      ("gaussian_mixture", GaussianMixture(k=4, seed=M.SEED))):
        pred = materialize(est.fit(x).transform(x).select("features", "prediction"))
        k = int(pred.select("prediction").distinct().count())
        rows.append((name, float(ev.evaluate(pred)) if k > 1 else None, k))
    return spark.createDataFrame(rows, "method string, silhouette double, clusters int")


@register("segment_migration", None, group=G)
def q_migration(spark, sf_dir):
    """P-09: for each segment the nearest segment with higher mean revenue
    (centroid distance over the k fitted centres), and the share of its
    customers with a checkout but no order."""
    import numpy as np
    from campanula.operators import ml as M
    from campanula.session import materialize
    t = tables(spark, sf_dir)
    x = materialize(M.segment_matrix(t.abt))
    model = M.best_kmeans(x, 4)
    centres = list(model.centres)   # k vectors: model output
    seg = materialize(model.transform(x).select("customer_id", F.col("prediction").alias("Segment"))
                      .join(t.abt.select("customer_id", "total_revenue", "total_orders", "total_checkout_started"),
                            "customer_id"))
    stats = seg.groupBy("Segment").agg(
        F.avg("total_revenue").alias("mean_revenue"), F.count(F.lit(1)).alias("n"),
        F.avg(((F.col("total_checkout_started") > 0) & (F.col("total_orders") == 0)).cast("double"))
        .alias("checkout_no_order_share")).collect()                     # k rows
    by = {r["Segment"]: r for r in stats}
    rows = []
    for s, r in by.items():
        better = [o for o in by if by[o]["mean_revenue"] > r["mean_revenue"]]
        target = min(better, key=lambda o: float(np.linalg.norm(centres[s] - centres[o]))) if better else None
        dist = float(np.linalg.norm(centres[s] - centres[target])) if target is not None else None
        rows.append((int(s), int(r["n"]), float(r["mean_revenue"]), target, dist, float(r["checkout_no_order_share"])))
    return spark.createDataFrame(rows, "Segment int, n long, mean_revenue double, migrate_to int, "
                                       "centroid_distance double, checkout_no_order_share double")


@register("unattributed_customers", """
SELECT count(*) AS n_customers,
  CAST((SELECT count(*) FROM customers c WHERE NOT EXISTS (
          SELECT 1 FROM leads l WHERE l.customer_id = c.customer_id)) AS BIGINT) AS n_without_leads,
  100.0 * (SELECT count(*) FROM customers c WHERE NOT EXISTS (
          SELECT 1 FROM leads l WHERE l.customer_id = c.customer_id)) / count(*) AS share_pct
FROM customers""", group="core")
def q_unattributed(spark, sf_dir):
    """JN-06: customers never seen as a lead (anti join)."""
    from campanula.operators.abt import scalar
    t = tables(spark, sf_dir)
    anti = t.customers.join(t.leads.select("customer_id"), "customer_id", "left_anti")
    n_anti = scalar(anti, F.count(F.lit(1)))
    return t.customers.agg(F.count(F.lit(1)).alias("n_customers")).select(
        "n_customers", n_anti.alias("n_without_leads"), (n_anti * 100.0 / F.col("n_customers")).alias("share_pct"))


@register("deceptive_campaign_ids", """
SELECT count(*) AS n_deceptive, COALESCE(string_agg(campaign_id, ', ' ORDER BY campaign_id), '') AS ids
FROM camp_quality WHERE deceptive_efficiency""", group="campaign")
def q_deceptive_ids(spark, sf_dir):
    """AGG-30: the flagged campaign ids as one sorted list (campaign grain)."""
    from campanula.plans.q_campaign import quality
    q = quality(tables(spark, sf_dir)).filter(F.col("deceptive_efficiency"))
    return q.agg(F.count(F.lit(1)).alias("n_deceptive"), D.id_list("campaign_id").alias("ids"))


@register("deceptive_campaign_id_blocks", """
SELECT block, min(campaign_id) AS first_id, max(campaign_id) AS last_id, count(*) AS n, string_agg(campaign_id, ', ' ORDER BY campaign_id) AS ids
FROM (SELECT campaign_id, CAST((row_number() OVER (ORDER BY campaign_id) - 1) // 50 AS BIGINT) AS block
      FROM (SELECT DISTINCT campaign_id FROM camp_quality WHERE deceptive_efficiency) d) x GROUP BY block""", group="campaign")
def q_deceptive_blocks(spark, sf_dir):
    """AGG-30 for any number of campaigns: the same list in blocks of 50 ids."""
    from campanula.plans.q_campaign import quality
    return D.id_list_blocks(quality(tables(spark, sf_dir)).filter(F.col("deceptive_efficiency")), "campaign_id", 50)


@register("customer_aov_sample", """
SELECT customer_id, total_revenue / total_orders AS cust_aov, total_sessions FROM abt WHERE total_orders > 0
ORDER BY md5(customer_id || ':42'), customer_id LIMIT 500""", group="describe")
def q_sample(spark, sf_dir):
    """TOP-04: a seeded sample of 500 customers (the reference's scatter sample);
    the limit is the feature."""
    t = tables(spark, sf_dir)
    cust = t.abt.filter(F.col("total_orders") > 0).select(
        "customer_id", (F.col("total_revenue") / F.col("total_orders")).alias("cust_aov"), "total_sessions")
    return D.sample_n(cust, 500, 42, "customer_id")
