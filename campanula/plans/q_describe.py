"""Descriptive queries (AGG-*, WIN-*, TOP-*, HIS-*) with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from campanula.operators import describe as D
from campanula.operators import ranks as RK
from campanula.plans.registry import register, tables
from campanula.plans.sqlbase import cte

G = "describe"

cte("first_touch", """
SELECT customer_id, channel_group AS first_touch_channel FROM sessions WHERE customer_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY session_date NULLS LAST, session_id) = 1""")

TXT = ", ".join(f"{c} NULLS FIRST" for c in D.TX_TIEBREAK)
TXT_DESC = ", ".join(f"{c} DESC NULLS LAST" for c in D.TX_TIEBREAK)

cte("tx_first", f"""
SELECT customer_id, order_date AS first_order_date, product_category AS first_product_category,
       payment_type AS first_payment_type
FROM transactions WHERE customer_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date NULLS LAST, {TXT}) = 1""")

cte("tx_second", f"""
SELECT customer_id, order_date AS second_order_date FROM transactions WHERE customer_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date NULLS LAST, {TXT}) = 2""")

cte("acq_channel", """
SELECT customer_id, channel AS acquisition_channel FROM (
  SELECT customer_id, channel, count(*) AS c FROM leads_camp
  WHERE customer_id IS NOT NULL AND channel IS NOT NULL GROUP BY customer_id, channel) t
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY c DESC, channel) = 1""")

cte("repeat_target", """
SELECT f.customer_id, f.first_order_date, f.first_product_category AS product_category,
       f.first_payment_type AS payment_type, s.second_order_date,
       date_diff('day', f.first_order_date, s.second_order_date) AS days_to_second,
       CAST(COALESCE(date_diff('day', f.first_order_date, s.second_order_date) BETWEEN 0 AND 90, false) AS INTEGER) AS repeat_90d
FROM tx_first f LEFT JOIN tx_second s ON f.customer_id = s.customer_id""")


def _qcut_sql(col: str, q: int, reverse: bool) -> str:
    rn = f"row_number() OVER (ORDER BY {col}, customer_id)"
    n = f"count({col}) OVER ()"
    b = f"CASE WHEN {n} <= 1 THEN 1 ELSE greatest(1, (({rn} - 1) * {q} + {n} - 2) // ({n} - 1)) END"
    if reverse:
        b = f"({q} + 1 - ({b}))"
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE CAST({b} AS INTEGER) END"


cte("rfm", f"""
SELECT customer_id, recency_days, total_orders, total_revenue, R_score, F_score, M_score,
  CASE WHEN R_score IS NULL OR F_score IS NULL OR M_score IS NULL THEN 'No Orders'
       WHEN R_score >= 4 AND F_score >= 4 AND M_score >= 4 THEN 'Champions'
       WHEN R_score <= 2 AND F_score >= 4 THEN 'At Risk'
       WHEN R_score <= 2 AND F_score <= 2 THEN 'Lost Causes'
       WHEN R_score >= 4 AND F_score <= 2 THEN 'New Customers'
       ELSE 'Average' END AS "RFM_Tier"
FROM (SELECT customer_id, recency_days, total_orders, total_revenue,
        {_qcut_sql('recency_days', 5, True)} AS R_score,
        {_qcut_sql('total_orders', 5, False)} AS F_score,
        {_qcut_sql('total_revenue', 5, False)} AS M_score
      FROM abt) t""")


def _conv_sql(key: str, src: str = "leads_camp") -> str:
    return f"""SELECT {key}, count(lead_id) AS n_leads, CAST(sum(CAST(converted_30d AS BIGINT)) AS BIGINT) AS conversions,
  CAST(sum(CAST(converted_30d AS BIGINT)) AS DOUBLE) / count(lead_id) AS lcr
FROM {src} WHERE {key} IS NOT NULL GROUP BY {key}"""


for _key in ("objective", "creative_type"):
    def _mk(key):
        def run(spark, sf_dir):
            t = tables(spark, sf_dir)
            return D.conversion_by(D.leads_with_campaign(t.leads, t.campaigns), key)
        return run
    register(f"conversion_by_{_key}", _conv_sql(_key), group=G)(_mk(_key))


@register("conversion_by_landing_page", _conv_sql("landing_page", "leads"), group=G)
def q_conv_lp(spark, sf_dir):
    return D.conversion_by(tables(spark, sf_dir).leads, "landing_page")


@register("conversion_by_discount_bracket", """
SELECT disc_bracket, count(lead_id) AS n_leads, CAST(sum(CAST(converted_30d AS BIGINT)) AS BIGINT) AS conversions,
  CAST(sum(CAST(converted_30d AS BIGINT)) AS DOUBLE) / count(lead_id) AS lcr
FROM (SELECT *, CASE WHEN d > -1 AND d <= 0 THEN '0%' WHEN d > 0 AND d <= 10 THEN '1-10%'
                     WHEN d > 10 AND d <= 15 THEN '11-15%' WHEN d > 15 AND d <= 20 THEN '16-20%'
                     WHEN d > 20 AND d <= 100 THEN '>20%' ELSE 'invalid' END AS disc_bracket
      FROM (SELECT *, COALESCE(discount_offered_pct, 0.0) AS d FROM leads) x) y
WHERE disc_bracket IS NOT NULL GROUP BY disc_bracket""", group=G)
def q_conv_disc(spark, sf_dir):
    t = tables(spark, sf_dir)
    return D.conversion_by(t.leads.withColumn("disc_bracket", D.discount_bracket(F.col("discount_offered_pct"))),
                           "disc_bracket")


@register("value_by_region", """
SELECT region, count(customer_id) AS customers, avg(total_revenue) AS avg_revenue,
  sum(total_revenue) AS total_revenue, avg("LCR") AS avg_lcr
FROM abt WHERE region IS NOT NULL GROUP BY region""", group=G)
def q_val_region(spark, sf_dir):
    return D.value_by(tables(spark, sf_dir).abt, "region", {"avg_lcr": F.avg("LCR")})


@register("value_by_device", """
SELECT preferred_device, count(customer_id) AS customers, avg(total_revenue) AS avg_revenue,
  sum(total_revenue) AS total_revenue, avg(avg_engagement_score) AS avg_engagement
FROM abt WHERE preferred_device IS NOT NULL GROUP BY preferred_device""", group=G)
def q_val_device(spark, sf_dir):
    return D.value_by(tables(spark, sf_dir).abt, "preferred_device",
                      {"avg_engagement": F.avg("avg_engagement_score")})


@register("channel_customer_quality", """
SELECT acquisition_channel, count(customer_id) AS n_customers, avg("CLV_proxy") AS avg_ltv,
  median("CLV_proxy") AS median_ltv, avg("AOV") AS avg_aov,
  avg(CAST(total_orders >= 2 AS DOUBLE)) AS repeat_rate, avg(total_acquisition_cost) AS avg_acq_cost,
  avg("CLV_proxy") / NULLIF(avg(total_acquisition_cost), 0) AS ltv_per_acq_cost
FROM (SELECT a.*, COALESCE(c.acquisition_channel, '(unattributed)') AS acquisition_channel
      FROM abt a LEFT JOIN acq_channel c ON a.customer_id = c.customer_id) t
GROUP BY acquisition_channel""", group=G)
def q_ch_quality(spark, sf_dir):
    t = tables(spark, sf_dir)
    return D.channel_quality(t.abt, t.leads, t.campaigns)


@register("category_analysis", """
SELECT s.*, g.first_purchase_repeat_rate FROM (
  SELECT product_category, count(order_id) AS n_transactions, sum(revenue_usd) AS total_revenue,
    avg(revenue_usd) AS avg_revenue, avg(CAST(returned_flag AS DOUBLE)) AS return_rate,
    avg(discount_pct) AS avg_discount
  FROM transactions WHERE product_category IS NOT NULL GROUP BY product_category) s
LEFT JOIN (
  SELECT f.first_product_category AS product_category, avg(CAST(o.c >= 2 AS DOUBLE)) AS first_purchase_repeat_rate
  FROM tx_first f JOIN (SELECT customer_id, count(*) AS c FROM transactions WHERE customer_id IS NOT NULL
                        GROUP BY customer_id) o ON f.customer_id = o.customer_id
  WHERE f.first_product_category IS NOT NULL GROUP BY f.first_product_category) g
ON s.product_category = g.product_category""", group=G)
def q_category(spark, sf_dir):
    return D.category_stats(tables(spark, sf_dir).transactions)


_RR = """SELECT {key} AS {out}, count(order_id) AS n_transactions, avg(CAST(returned_flag AS DOUBLE)) AS return_rate,
  CAST(sum(CAST(returned_flag AS BIGINT)) AS BIGINT) AS total_returns, avg(revenue_usd) AS avg_revenue
FROM transactions WHERE {key} IS NOT NULL GROUP BY {key}"""


@register("return_rate_by_channel", "SELECT *, COALESCE(return_rate > (SELECT avg(return_rate) FROM ("
          + _RR.format(key="marketing_channel_last_touch", out="marketing_channel")
          + ") z), false) AS above_mean FROM (" + _RR.format(key="marketing_channel_last_touch", out="marketing_channel")
          + ") r", group=G)
def q_rr_channel(spark, sf_dir):
    rr = D.return_rate_by(tables(spark, sf_dir).transactions, "marketing_channel_last_touch", "marketing_channel")
    return D.flag_above_mean(rr, "return_rate")


@register("return_rate_by_category", "SELECT *, COALESCE(return_rate > (SELECT avg(return_rate) FROM ("
          + _RR.format(key="product_category", out="product_category")
          + ") z), false) AS above_mean FROM (" + _RR.format(key="product_category", out="product_category")
          + ") r", group=G)
def q_rr_category(spark, sf_dir):
    rr = D.return_rate_by(tables(spark, sf_dir).transactions, "product_category")
    return D.flag_above_mean(rr, "return_rate")


@register("attribution", """
SELECT COALESCE(l.channel, f.channel) AS channel, COALESCE(l.last_touch_revenue, 0.0) AS last_touch_revenue,
       COALESCE(f.first_touch_revenue, 0.0) AS first_touch_revenue
FROM (SELECT marketing_channel_last_touch AS channel, sum(revenue_usd) AS last_touch_revenue FROM transactions
      WHERE marketing_channel_last_touch IS NOT NULL GROUP BY 1) l
FULL OUTER JOIN (
  SELECT ft.first_touch_channel AS channel, sum(t.revenue_usd) AS first_touch_revenue
  FROM transactions t LEFT JOIN first_touch ft ON t.customer_id = ft.customer_id
  WHERE ft.first_touch_channel IS NOT NULL GROUP BY 1) f
ON l.channel = f.channel""", group=G)
def q_attribution(spark, sf_dir):
    t = tables(spark, sf_dir)
    return D.attribution(t.transactions, t.sessions)


@register("landing_page_performance", """
SELECT l.landing_page, count(s.session_id) AS sessions,
  avg(CAST(s.bounce AS DOUBLE)) AS bounce_rate, avg(s.pages_viewed) AS avg_pages
FROM sessions s JOIN leads l ON s.customer_id = l.customer_id
WHERE l.landing_page IS NOT NULL
GROUP BY l.landing_page ORDER BY sessions DESC, l.landing_page LIMIT 10""", group=G)
def q_landing(spark, sf_dir):
    t = tables(spark, sf_dir)
    return D.top_k(D.landing_perf(t.sessions, t.leads), [F.col("sessions").desc(), F.col("landing_page").asc()], 10)


@register("cohort_retention", """
WITH cust AS (SELECT customer_id, CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month FROM customers
              WHERE signup_date IS NOT NULL),
j AS (SELECT t.customer_id, c.cohort_month,
        CAST((year(t.order_date) - year(c.cohort_month)) * 12 + (month(t.order_date) - month(c.cohort_month)) AS BIGINT) AS period
      FROM transactions t JOIN cust c ON t.customer_id = c.customer_id WHERE t.order_date IS NOT NULL),
counts AS (SELECT cohort_month, period, count(DISTINCT customer_id) AS buyers FROM j
           WHERE period >= 0 AND period < 12 GROUP BY cohort_month, period),
sz AS (SELECT cohort_month, count(*) AS cohort_size FROM cust GROUP BY cohort_month)
SELECT c.cohort_month, c.period, c.buyers, sz.cohort_size,
  CAST(c.buyers AS DOUBLE) / NULLIF(CAST(m0.buyers AS DOUBLE), 0) AS retained_vs_m0,
  CAST(c.buyers AS DOUBLE) / NULLIF(CAST(sz.cohort_size AS DOUBLE), 0) AS retained_vs_cohort
FROM counts c LEFT JOIN (SELECT cohort_month, buyers FROM counts WHERE period = 0) m0 ON c.cohort_month = m0.cohort_month
LEFT JOIN sz ON c.cohort_month = sz.cohort_month""", group=G)
def q_cohort(spark, sf_dir):
    t = tables(spark, sf_dir)
    return D.cohort_retention(t.transactions, t.customers)


@register("rfm_scores", "SELECT * FROM rfm", group=G)
def q_rfm(spark, sf_dir):
    return D.rfm_scores(tables(spark, sf_dir).abt)


@register("rfm_tier_summary", """
SELECT "RFM_Tier", count(customer_id) AS count, avg(total_revenue) AS avg_revenue, sum(total_revenue) AS total_revenue
FROM rfm GROUP BY "RFM_Tier" """, group=G)
def q_rfm_summary(spark, sf_dir):
    return D.tier_summary(D.rfm_scores(tables(spark, sf_dir).abt))


@register("optin_gap_by_rfm_tier", """
SELECT r."RFM_Tier", CAST(count_if(a.email_opt_in) AS BIGINT) AS opted_in,
  CAST(count_if(NOT a.email_opt_in) AS BIGINT) AS not_opted_in, r."RFM_Tier" = 'Champions' AS is_gap_segment
FROM rfm r JOIN abt a ON r.customer_id = a.customer_id GROUP BY r."RFM_Tier" """, group=G)
def q_optin(spark, sf_dir):
    t = tables(spark, sf_dir)
    rfm = D.rfm_scores(t.abt).select("customer_id", "RFM_Tier")
    return D.optin_gap(rfm.join(t.abt.select("customer_id", "email_opt_in"), "customer_id"), "RFM_Tier")


_UPLIFT = """
SELECT {key}, no_discount, discounted_lcr, (discounted_lcr - no_discount) * 100 AS uplift_pp FROM (
  SELECT {key}, avg(CASE WHEN NOT t THEN y END) AS no_discount, avg(CASE WHEN t THEN y END) AS discounted_lcr
  FROM (SELECT {key}, COALESCE(discount_offered_pct > 0, false) AS t, CAST(converted_30d AS DOUBLE) AS y FROM {src}) s
  WHERE {key} IS NOT NULL GROUP BY {key}) g
WHERE no_discount IS NOT NULL AND discounted_lcr IS NOT NULL"""


@register("uplift_by_channel", _UPLIFT.format(key="channel", src="leads_camp"), group=G)
def q_uplift_channel(spark, sf_dir):
    t = tables(spark, sf_dir)
    return D.uplift_by(D.leads_with_campaign(t.leads, t.campaigns), "channel",
                       F.col("discount_offered_pct") > 0, "converted_30d")


@register("uplift_by_loyalty_tier", _UPLIFT.format(
    key="loyalty_tier",
    src="(SELECT l.*, a.loyalty_tier FROM leads l LEFT JOIN abt a ON l.customer_id = a.customer_id) lt"), group=G)
def q_uplift_tier(spark, sf_dir):
    t = tables(spark, sf_dir)
    lt = D.lookup(t.leads, t.abt, "customer_id", ["loyalty_tier"])
    return D.uplift_by(lt, "loyalty_tier", F.col("discount_offered_pct") > 0, "converted_30d")


@register("crosstab_channel_conversion", """
SELECT channel, converted_30d, count(*) AS n FROM leads_camp
WHERE channel IS NOT NULL AND converted_30d IS NOT NULL GROUP BY channel, converted_30d""", group=G)
def q_crosstab(spark, sf_dir):
    t = tables(spark, sf_dir)
    return D.crosstab(D.leads_with_campaign(t.leads, t.campaigns), "channel", "converted_30d")


@register("histogram_clv", """
WITH b AS (SELECT min(total_revenue) AS lo, max(total_revenue) AS hi, (max(total_revenue) - min(total_revenue)) / 30 AS w FROM abt),
c AS (SELECT CAST(CASE WHEN (SELECT w FROM b) > 0
                       THEN least(floor((a.total_revenue - (SELECT lo FROM b)) / (SELECT w FROM b)), 29) ELSE 0 END
                  AS BIGINT) AS bin, count(*) AS n
      FROM abt a WHERE a.total_revenue IS NOT NULL GROUP BY 1)
SELECT g.range AS bin, (SELECT lo FROM b) + g.range * (SELECT w FROM b) AS lo,
  (SELECT lo FROM b) + (g.range + 1) * (SELECT w FROM b) AS hi, COALESCE(c.n, 0) AS n
FROM range(30) g LEFT JOIN c ON g.range = c.bin""", group=G)
def q_hist(spark, sf_dir):
    return D.histogram(tables(spark, sf_dir).abt, "total_revenue", 30)


@register("gini_ltv", """
SELECT CAST(count(*) AS BIGINT) AS n,
  sum((2 * rn - n_all - 1) * x) / NULLIF(n_all * sum(x), 0) AS gini
FROM (SELECT greatest(CAST("CLV_proxy" AS DOUBLE), 0.0) AS x,
             row_number() OVER (ORDER BY greatest(CAST("CLV_proxy" AS DOUBLE), 0.0)) AS rn,
             count(*) OVER () AS n_all
      FROM abt WHERE "CLV_proxy" IS NOT NULL) t GROUP BY n_all""", group=G)
def q_gini(spark, sf_dir):
    return RK.gini(tables(spark, sf_dir).abt, "CLV_proxy")


@register("lorenz_ltv", """
SELECT x AS value, CAST(sum(c) OVER (ORDER BY x) AS BIGINT) AS cum_count,
  sum(c) OVER (ORDER BY x) / (SELECT count(*) FROM abt WHERE "CLV_proxy" IS NOT NULL) AS pop_share,
  sum(s) OVER (ORDER BY x) / NULLIF((SELECT sum(greatest(CAST("CLV_proxy" AS DOUBLE), 0.0)) FROM abt), 0) AS value_share
FROM (SELECT greatest(CAST("CLV_proxy" AS DOUBLE), 0.0) AS x, count(*) AS c,
             sum(greatest(CAST("CLV_proxy" AS DOUBLE), 0.0)) AS s
      FROM abt WHERE "CLV_proxy" IS NOT NULL GROUP BY 1) t""", group=G)
def q_lorenz(spark, sf_dir):
    return RK.lorenz(tables(spark, sf_dir).abt, "CLV_proxy")


@register("ltv_by_loyalty_tier", """
SELECT loyalty_tier, avg("CLV_proxy") AS mean, median("CLV_proxy") AS median, count("CLV_proxy") AS count
FROM abt WHERE loyalty_tier IS NOT NULL GROUP BY loyalty_tier""", group=G)
def q_ltv_tier(spark, sf_dir):
    return D.summary_by(tables(spark, sf_dir).abt, "loyalty_tier", "CLV_proxy")


cte("converted_leads", """
SELECT *, date_diff('day', lead_date, conversion_date) AS days_to_convert FROM leads_camp
WHERE converted_30d AND conversion_date IS NOT NULL AND lead_date IS NOT NULL""")


@register("days_to_convert_by_channel", """
SELECT channel, avg(days_to_convert) AS mean_days, median(days_to_convert) AS median_days, count(days_to_convert) AS n
FROM converted_leads WHERE channel IS NOT NULL GROUP BY channel""", group=G)
def q_dtc(spark, sf_dir):
    t = tables(spark, sf_dir)
    return D.summary_by(converted_leads(t), "channel", "days_to_convert", ("mean", "median", "count"),
                        prefix="_").select("channel", F.col("_mean").alias("mean_days"),
                                           F.col("_median").alias("median_days"), F.col("_count").alias("n"))


def converted_leads(t):
    from campanula.functions import clean as C
    lc = D.leads_with_campaign(t.leads, t.campaigns)
    return (lc.filter(F.col("converted_30d") & F.col("conversion_date").isNotNull() & F.col("lead_date").isNotNull())
            .withColumn("days_to_convert", C.days_between("conversion_date", "lead_date")))


cte("last_touch", f"""
SELECT customer_id, marketing_channel_last_touch AS channel FROM transactions
WHERE customer_id IS NOT NULL AND marketing_channel_last_touch IS NOT NULL AND order_date IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, {TXT_DESC}) = 1""")

cte("aov_last_touch", """
SELECT a.customer_id, l.channel, a.total_revenue / a.total_orders AS cust_aov
FROM abt a JOIN last_touch l ON a.customer_id = l.customer_id WHERE a.total_orders > 0""")


@register("aov_by_last_touch", """
SELECT channel, avg(cust_aov) AS mean_aov, stddev_samp(cust_aov) AS std, count(cust_aov) AS count
FROM aov_last_touch GROUP BY channel""", group=G)
def q_aov_lt(spark, sf_dir):
    s = D.summary_by(aov_last_touch(tables(spark, sf_dir)), "channel", "cust_aov", ("mean", "std", "count"), "_")
    return s.select("channel", F.col("_mean").alias("mean_aov"), F.col("_std").alias("std"),
                    F.col("_count").alias("count"))


def aov_last_touch(t):
    lt = D.last_by(t.transactions.filter(F.col("order_date").isNotNull()), "customer_id", "order_date",
                   D.TX_TIEBREAK, "marketing_channel_last_touch", "channel")
    return (t.abt.filter(F.col("total_orders") > 0).join(lt, "customer_id")
            .select("customer_id", "channel", (F.col("total_revenue") / F.col("total_orders")).alias("cust_aov")))


@register("repeat_target", "SELECT * FROM repeat_target", group=G)
def q_repeat(spark, sf_dir):
    return tables(spark, sf_dir).repeat_target


def _cohort_matrix_sql():
    cols = ", ".join(f"max(CASE WHEN period = {i} THEN retained_vs_m0 END) AS m{i}" for i in range(12))
    return f"SELECT cohort_month, {cols} FROM cohort_long GROUP BY cohort_month"


cte("cohort_long", """
SELECT c.cohort_month, c.period,
  CAST(c.buyers AS DOUBLE) / NULLIF(CAST(m0.buyers AS DOUBLE), 0) AS retained_vs_m0
FROM (SELECT cohort_month, period, count(DISTINCT customer_id) AS buyers FROM (
        SELECT t.customer_id, c.cohort_month,
          CAST((year(t.order_date) - year(c.cohort_month)) * 12 + (month(t.order_date) - month(c.cohort_month)) AS BIGINT) AS period
        FROM transactions t JOIN (SELECT customer_id, CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month
                                  FROM customers WHERE signup_date IS NOT NULL) c ON t.customer_id = c.customer_id
        WHERE t.order_date IS NOT NULL) j
      WHERE period >= 0 AND period < 12 GROUP BY cohort_month, period) c
LEFT JOIN (SELECT cohort_month, count(DISTINCT customer_id) AS buyers FROM (
        SELECT t.customer_id, c.cohort_month,
          (year(t.order_date) - year(c.cohort_month)) * 12 + (month(t.order_date) - month(c.cohort_month)) AS period
        FROM transactions t JOIN (SELECT customer_id, CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month
                                  FROM customers WHERE signup_date IS NOT NULL) c ON t.customer_id = c.customer_id
        WHERE t.order_date IS NOT NULL) j0 WHERE period = 0 GROUP BY cohort_month) m0
ON c.cohort_month = m0.cohort_month""")


@register("cohort_matrix", _cohort_matrix_sql(), group=G)
def q_cohort_matrix(spark, sf_dir):
    """AGG-17 display form: retention vs month 0, one column per month since signup."""
    t = tables(spark, sf_dir)
    return D.cohort_matrix(D.cohort_retention(t.transactions, t.customers))
