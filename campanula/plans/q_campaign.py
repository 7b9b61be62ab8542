"""Campaign queries (CMP-*, AGG-23/24/25/31) with oracle SQL."""

from __future__ import annotations

from campanula.operators import campaign as CP
from campanula.plans.registry import register, tables
from campanula.plans.sqlbase import cte

G = "campaign"


def features(t):
    if not hasattr(t, "_features"):
        t._features = CP.campaign_features(t.campaigns, t.leads, t.transactions)
    return t._features


def quality(t):
    if not hasattr(t, "_quality"):
        t._quality = CP.campaign_quality(features(t), t.leads, t.abt)
    return t._quality


cte("camp_rollup", """
SELECT l.campaign_id, count(l.lead_id) AS total_leads,
  CAST(sum(CAST(l.converted_30d AS BIGINT)) AS BIGINT) AS converted_leads,
  COALESCE(CAST(sum(CAST(r.rev AS DECIMAL(20,2))) AS DOUBLE), 0.0) AS total_revenue
FROM leads l LEFT JOIN (SELECT customer_id, CAST(sum(CAST(revenue_usd AS DECIMAL(20,2))) AS DOUBLE) AS rev FROM transactions
                        WHERE customer_id IS NOT NULL GROUP BY customer_id) r ON l.customer_id = r.customer_id
WHERE l.customer_id IS NOT NULL AND l.campaign_id IS NOT NULL GROUP BY l.campaign_id""")

cte("camp_features0", """
SELECT c.*, COALESCE(r.total_leads, 0) AS total_leads, COALESCE(r.converted_leads, 0) AS converted_leads,
  COALESCE(r.total_revenue, 0.0) AS total_revenue
FROM campaigns c LEFT JOIN camp_rollup r ON c.campaign_id = r.campaign_id""")

cte("camp_features", """
SELECT *,
  CASE WHEN total_leads > 0 THEN CAST(converted_leads AS DOUBLE) / total_leads ELSE 0.0 END AS "LCR",
  CASE WHEN converted_leads > 0 THEN spend_usd / converted_leads ELSE 0.0 END AS "CPA",
  CASE WHEN COALESCE(spend_usd > 0, false) THEN total_revenue / spend_usd ELSE 0.0 END AS "ROAS",
  spend_usd / NULLIF(budget_usd, 0) AS budget_utilization,
  COALESCE(spend_usd > (SELECT quantile_cont(spend_usd, 0.99) FROM camp_features0), false) AS spend_anomaly
FROM camp_features0""")

cte("camp_quality0", """
SELECT f.*, d.avg_customer_ltv, d.repeat_rate FROM camp_features f LEFT JOIN (
  SELECT l.campaign_id, avg(a."CLV_proxy") AS avg_customer_ltv,
         avg(CAST(COALESCE(a.total_orders, 0) >= 2 AS DOUBLE)) AS repeat_rate
  FROM leads l LEFT JOIN abt a ON l.customer_id = a.customer_id
  WHERE l.customer_id IS NOT NULL AND l.campaign_id IS NOT NULL GROUP BY l.campaign_id) d
ON f.campaign_id = d.campaign_id""")

cte("camp_quality", """
SELECT *, COALESCE("ROAS" > (SELECT median("ROAS") FROM camp_quality0)
   AND COALESCE(repeat_rate, 0.0) < (SELECT median(COALESCE(repeat_rate, 0.0)) FROM camp_quality0)
   AND repeat_rate IS NOT NULL, false) AS deceptive_efficiency
FROM camp_quality0""")


@register("campaign_features", "SELECT * FROM camp_features", group=G)
def q_features(spark, sf_dir):
    return features(tables(spark, sf_dir))


@register("campaign_quality", """
SELECT campaign_id, channel, "ROAS", "LCR", repeat_rate, avg_customer_ltv, deceptive_efficiency
FROM camp_quality""", group=G)
def q_quality(spark, sf_dir):
    return quality(tables(spark, sf_dir)).select(
        "campaign_id", "channel", "ROAS", "LCR", "repeat_rate", "avg_customer_ltv", "deceptive_efficiency")


@register("budget_reallocation", """
WITH ch AS (SELECT channel, COALESCE(sum(spend_usd), 0.0) AS total_spend, avg("ROAS") AS avg_roas,
              avg("LCR") AS avg_lcr, avg(avg_customer_ltv) AS avg_ltv, avg(repeat_rate) AS avg_repeat_rate
            FROM camp_quality WHERE channel IS NOT NULL GROUP BY channel),
n AS (SELECT *,
  round_even(
    CASE WHEN max(COALESCE(avg_roas, 0.0)) OVER () - min(COALESCE(avg_roas, 0.0)) OVER () > 0
         THEN (COALESCE(avg_roas, 0.0) - min(COALESCE(avg_roas, 0.0)) OVER ())
              / (max(COALESCE(avg_roas, 0.0)) OVER () - min(COALESCE(avg_roas, 0.0)) OVER ()) ELSE 1.0 END * 0.35
  + CASE WHEN max(COALESCE(avg_lcr, 0.0)) OVER () - min(COALESCE(avg_lcr, 0.0)) OVER () > 0
         THEN (COALESCE(avg_lcr, 0.0) - min(COALESCE(avg_lcr, 0.0)) OVER ())
              / (max(COALESCE(avg_lcr, 0.0)) OVER () - min(COALESCE(avg_lcr, 0.0)) OVER ()) ELSE 1.0 END * 0.25
  + CASE WHEN max(COALESCE(avg_ltv, 0.0)) OVER () - min(COALESCE(avg_ltv, 0.0)) OVER () > 0
         THEN (COALESCE(avg_ltv, 0.0) - min(COALESCE(avg_ltv, 0.0)) OVER ())
              / (max(COALESCE(avg_ltv, 0.0)) OVER () - min(COALESCE(avg_ltv, 0.0)) OVER ()) ELSE 1.0 END * 0.25
  + CASE WHEN max(COALESCE(avg_repeat_rate, 0.0)) OVER () - min(COALESCE(avg_repeat_rate, 0.0)) OVER () > 0
         THEN (COALESCE(avg_repeat_rate, 0.0) - min(COALESCE(avg_repeat_rate, 0.0)) OVER ())
              / (max(COALESCE(avg_repeat_rate, 0.0)) OVER () - min(COALESCE(avg_repeat_rate, 0.0)) OVER ()) ELSE 1.0 END * 0.15,
  3) AS composite_score FROM ch),
p AS (SELECT *,
  round_even(total_spend / CASE WHEN sum(total_spend) OVER () = 0 THEN 1.0 ELSE sum(total_spend) OVER () END * 100, 1) AS current_budget_pct,
  round_even(composite_score / sum(composite_score) OVER () * 100, 1) AS recommended_budget_pct
  FROM n)
SELECT *, round_even(recommended_budget_pct - current_budget_pct, 1) AS budget_shift_pp FROM p""", group=G)
def q_budget(spark, sf_dir):
    return CP.budget_reallocation(quality(tables(spark, sf_dir)))


@register("channel_efficiency", """
SELECT channel, avg("ROAS") AS "ROAS", avg("LCR") AS "LCR", avg(spend_usd) AS spend_usd
FROM camp_features WHERE channel IS NOT NULL GROUP BY channel""", group=G)
def q_ch_eff(spark, sf_dir):
    return CP.channel_efficiency(features(tables(spark, sf_dir)))


cte("campaigns_cleaned", """
SELECT campaign_id, channel, spend_usd, total_revenue,
  COALESCE(spend_usd < 0 OR spend_usd > (SELECT quantile_cont(spend_usd, 0.99) FROM camp_features), false) AS spend_anomaly_flag,
  CASE WHEN COALESCE(spend_usd > 0, false) AND total_revenue IS NOT NULL THEN total_revenue / spend_usd END AS clean_roas,
  CASE WHEN COALESCE(spend_usd > 0, false) AND total_revenue IS NOT NULL THEN total_revenue * 0.3 / spend_usd END AS margin_roas,
  CASE WHEN spend_usd IS NULL THEN NULL ELSE least(greatest(spend_usd,
        (SELECT quantile_cont(spend_usd, 0.01) FROM camp_features)),
        (SELECT quantile_cont(spend_usd, 0.99) FROM camp_features)) END AS spend_wins
FROM camp_features""")


@register("campaigns_cleaned", "SELECT * FROM campaigns_cleaned", group=G)
def q_cleaned(spark, sf_dir):
    return CP.margin_roas(features(tables(spark, sf_dir)))


@register("roas_summary", """
SELECT avg(clean_roas) AS mean_clean_roas, median(clean_roas) AS median_clean_roas,
  avg(margin_roas) AS mean_margin_roas, CAST(count_if(spend_anomaly_flag) AS BIGINT) AS n_anomalies
FROM campaigns_cleaned""", group=G)
def q_roas_summary(spark, sf_dir):
    return CP.roas_summary(CP.margin_roas(features(tables(spark, sf_dir))))


@register("leads_per_campaign", """
SELECT c.campaign_id, c.spend_usd, COALESCE(n.n_leads, 0) AS n_leads
FROM campaigns c LEFT JOIN (SELECT campaign_id, count(*) AS n_leads FROM leads
                            WHERE campaign_id IS NOT NULL GROUP BY campaign_id) n ON c.campaign_id = n.campaign_id""",
          group=G)
def q_lpc(spark, sf_dir):
    t = tables(spark, sf_dir)
    return CP.leads_per_campaign(t.campaigns, t.leads)


@register("creative_objective_lcr", """
SELECT creative_type,
  avg(CASE WHEN objective = 'Lead Gen' THEN "LCR" END) AS "Lead Gen",
  avg(CASE WHEN objective = 'Awareness' THEN "LCR" END) AS "Awareness",
  avg(CASE WHEN objective = 'Retention' THEN "LCR" END) AS "Retention",
  avg(CASE WHEN objective = 'Conversion' THEN "LCR" END) AS "Conversion"
FROM camp_features WHERE creative_type IS NOT NULL GROUP BY creative_type""",
          group=G)
def q_pivot(spark, sf_dir):
    from campanula.operators.describe import pivot_mean
    return pivot_mean(features(tables(spark, sf_dir)), "creative_type", "objective", "LCR")
