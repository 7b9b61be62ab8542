"""Core queries: silver tables, audit, ABT, KPI row, channel conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from campanula.functions import clean as C
from campanula.operators import abt as A
from campanula.operators import audit as AU
from campanula.operators import describe as D
from campanula.plans.registry import register, tables
from campanula.plans.sqlbase import cte, currency, to_number
from campanula.sources import files as FI

# --- oracle CTEs ------------------------------------------------------------
cte("abt_base", """
SELECT c.*,
  COALESCE(l.total_leads, 0) AS total_leads, COALESCE(l.converted_leads, 0) AS converted_leads,
  l.avg_lead_score, COALESCE(l.total_acquisition_cost, 0.0) AS total_acquisition_cost,
  COALESCE(s.total_sessions, 0) AS total_sessions, s.avg_pages_viewed, s.avg_time_on_site,
  COALESCE(s.total_add_to_cart, 0) AS total_add_to_cart,
  COALESCE(s.total_checkout_started, 0) AS total_checkout_started, s.avg_engagement_score,
  COALESCE(t.total_orders, 0) AS total_orders, COALESCE(t.total_revenue, 0.0) AS total_revenue,
  COALESCE(t.total_units, 0.0) AS total_units, COALESCE(t.total_returned, 0) AS total_returned,
  t.last_order_date
FROM customers c
LEFT JOIN (SELECT customer_id, count(lead_id) AS total_leads,
                  CAST(sum(CAST(converted_30d AS BIGINT)) AS BIGINT) AS converted_leads,
                  avg(lead_score) AS avg_lead_score,
                  COALESCE(CAST(sum(CAST(acquisition_cost_usd AS DECIMAL(20,2))) AS DOUBLE), 0.0) AS total_acquisition_cost
           FROM leads WHERE customer_id IS NOT NULL GROUP BY customer_id) l
  ON c.customer_id = l.customer_id
LEFT JOIN (SELECT customer_id, count(session_id) AS total_sessions,
                  avg(pages_viewed) AS avg_pages_viewed, avg(time_on_site_sec) AS avg_time_on_site,
                  CAST(sum(CAST(add_to_cart AS BIGINT)) AS BIGINT) AS total_add_to_cart,
                  CAST(sum(CAST(checkout_started AS BIGINT)) AS BIGINT) AS total_checkout_started,
                  avg(CAST(checkout_started AS INTEGER) * 3 + CAST(add_to_cart AS INTEGER) * 2
                      + COALESCE(pages_viewed, 0.0) / 10.0 - CAST(bounce AS INTEGER)) AS avg_engagement_score
           FROM sessions WHERE customer_id IS NOT NULL GROUP BY customer_id) s
  ON c.customer_id = s.customer_id
LEFT JOIN (SELECT customer_id, count(order_id) AS total_orders,
                  COALESCE(CAST(sum(CAST(revenue_usd AS DECIMAL(20,2))) AS DOUBLE), 0.0) AS total_revenue,
                  COALESCE(CAST(sum(CAST(units AS DECIMAL(20,2))) AS DOUBLE), 0.0) AS total_units,
                  CAST(sum(CAST(returned_flag AS BIGINT)) AS BIGINT) AS total_returned,
                  max(order_date) AS last_order_date
           FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id) t
  ON c.customer_id = t.customer_id""")

cte("abt", """
SELECT *,
  CAST(converted_leads AS DOUBLE) / NULLIF(CAST(total_leads AS DOUBLE), 0) AS "LCR",
  total_acquisition_cost / NULLIF(CAST(converted_leads AS DOUBLE), 0) AS "CPA",
  total_revenue / NULLIF(CAST(total_orders AS DOUBLE), 0) AS "AOV",
  CAST(total_returned AS DOUBLE) / NULLIF(CAST(total_orders AS DOUBLE), 0) AS return_rate,
  total_revenue AS "CLV_proxy",
  date_diff('day', last_order_date, (SELECT max(order_date) FROM transactions)) AS recency_days
FROM abt_base""")

cte("leads_camp", """
SELECT l.*, c.channel, c.spend_usd, c.objective, c.budget_usd, c.creative_type
FROM leads l LEFT JOIN campaigns c ON l.campaign_id = c.campaign_id""")


# --- silver tables: every CLN operator, checked column by column -----------
def _silver(name):
    def run(spark, sf_dir):
        return tables(spark, sf_dir).silver_table(name)
    return run


for _name in ("customers", "campaigns", "leads", "sessions", "transactions"):
    register(f"clean_{_name}", f"SELECT * FROM {_name}", group="clean")(_silver(_name))


@register("abt", "SELECT * FROM abt")
def q_abt(spark, sf_dir):
    return tables(spark, sf_dir).abt


@register("kpi_summary", """
SELECT CAST(sum(total_leads) AS BIGINT) AS total_leads,
  CAST(sum(converted_leads) AS BIGINT) AS conversions,
  CASE WHEN sum(total_leads) > 0 THEN sum(converted_leads) / sum(total_leads) ELSE 0.0 END AS lcr,
  sum(total_revenue) AS total_revenue,
  CAST(sum(total_orders) AS BIGINT) AS total_orders,
  CASE WHEN sum(total_orders) > 0 THEN sum(total_revenue) / sum(total_orders) ELSE 0.0 END AS aov,
  count(DISTINCT customer_id) AS total_customers,
  avg(CAST(total_orders > 1 AS DOUBLE)) AS repeat_rate,
  CASE WHEN count(DISTINCT customer_id) > 0 THEN sum(total_revenue) / count(DISTINCT customer_id) ELSE 0.0 END
    AS revenue_per_customer,
  avg("AOV") AS avg_customer_aov
FROM abt""")
def q_kpi(spark, sf_dir):
    return A.kpi_summary(tables(spark, sf_dir).abt)


@register("conversion_by_channel", """
WITH g AS (SELECT channel, count(lead_id) AS n_leads,
                  CAST(sum(CAST(converted_30d AS BIGINT)) AS BIGINT) AS conversions,
                  avg(spend_usd) AS avg_spend_per_lead_row
           FROM leads_camp WHERE channel IS NOT NULL GROUP BY channel),
     s AS (SELECT channel, sum(spend_usd) AS channel_spend FROM campaigns
           WHERE channel IS NOT NULL GROUP BY channel)
SELECT g.channel, n_leads, conversions, CAST(conversions AS DOUBLE) / n_leads AS lcr,
  avg_spend_per_lead_row, s.channel_spend / n_leads AS cpl
FROM g LEFT JOIN s ON g.channel = s.channel""")
def q_conv_channel(spark, sf_dir):
    t = tables(spark, sf_dir)
    return D.channel_conversion(t.leads, t.campaigns)


# --- audit ------------------------------------------------------------------
_AUDIT_SQL = f"""
SELECT table_name, check_name, CAST(n AS BIGINT) AS n FROM (
  SELECT 'customers' AS table_name, 'duplicate_ids' AS check_name,
         count(*) - count(DISTINCT customer_id) - max(CAST(customer_id IS NULL AS BIGINT)) AS n FROM b_customers
  UNION ALL SELECT 'customers', 'invalid_age',
         count_if({to_number('age')} < 0 OR {to_number('age')} > 120) FROM b_customers
  UNION ALL SELECT 'campaigns', 'spend_gt_budget_raw',
         count_if({currency('spend_usd')} > {currency('budget_usd')}) FROM b_campaigns
  UNION ALL SELECT 'campaigns', 'duplicate_ids',
         count(*) - count(DISTINCT campaign_id) - max(CAST(campaign_id IS NULL AS BIGINT)) FROM b_campaigns
  UNION ALL SELECT 'campaigns', 'negative_spend', count_if({currency('spend_usd')} < 0) FROM b_campaigns
  UNION ALL SELECT 'campaigns', 'spend_gt_budget_deduped', count_if(spend_usd > budget_usd) FROM campaigns
  UNION ALL SELECT 'campaigns', 'clicks_gt_impressions', count_if(clicks > impressions) FROM campaigns
  UNION ALL SELECT 'campaigns', 'end_before_start', count_if(end_date < start_date) FROM campaigns
  UNION ALL SELECT 'leads', 'anonymous', count_if(customer_id IS NULL) FROM b_leads
  UNION ALL SELECT 'leads', 'unattributed', count_if(campaign_id IS NULL) FROM b_leads
  UNION ALL SELECT 'leads', 'impossible_dates', count_if(cd < ld) FROM
         (SELECT {{date_ld}} AS ld, {{date_cd}} AS cd FROM b_leads) x
  UNION ALL SELECT 'leads', 'conversion_conflict', count_if(conversion_date IS NOT NULL AND NOT converted_30d) FROM leads
  UNION ALL SELECT 'sessions', 'invalid_pages', count_if({to_number('pages_viewed')} <= 0) FROM b_sessions
  UNION ALL SELECT 'sessions', 'invalid_time',
         count_if({to_number('time_on_site_sec')} <= 0 OR {to_number('time_on_site_sec')} > 86400) FROM b_sessions
  UNION ALL SELECT 'transactions', 'invalid_revenue', count_if(revenue_usd <= 0) FROM transactions
  UNION ALL SELECT 'transactions', 'invalid_units', count_if(units <= 0) FROM transactions
  UNION ALL SELECT 'transactions', 'duplicate_ids',
         count(*) - count(DISTINCT order_id) - max(CAST(order_id IS NULL AS BIGINT)) FROM b_transactions
) u"""


def _audit_sql():
    from campanula.plans.sqlbase import date
    return _AUDIT_SQL.replace("{date_ld}", date("lead_date")).replace("{date_cd}", date("conversion_date"))


@register("audit_counts", _audit_sql(), group="audit")
def q_audit(spark, sf_dir):
    t = tables(spark, sf_dir)
    b = t.bronze
    age = C.to_number("age")
    parts = [
        b["customers"].agg(AU.dup_count(b["customers"], "customer_id").alias("duplicate_ids"),
                           F.count_if(F.coalesce((age < 0) | (age > 120), F.lit(False))).cast("bigint").alias("invalid_age"))
        .unpivot([], ["duplicate_ids", "invalid_age"], "check_name", "n")
        .select(F.lit("customers").alias("table_name"), "check_name", "n"),
    ]
    spend, budget = C.clean_currency("spend_usd"), C.clean_currency("budget_usd")
    parts.append(AU.rule_counts(b["campaigns"], {"spend_gt_budget_raw": spend > budget}, "campaigns"))
    parts.append(b["campaigns"].agg(AU.dup_count(b["campaigns"], "campaign_id").alias("duplicate_ids"),
                                    F.count_if(F.coalesce(spend < 0, F.lit(False))).cast("bigint").alias("negative_spend"))
                 .unpivot([], ["duplicate_ids", "negative_spend"], "check_name", "n")
                 .select(F.lit("campaigns").alias("table_name"), "check_name", "n"))
    parts.append(AU.rule_counts(t.campaigns, {
        "spend_gt_budget_deduped": F.col("spend_usd") > F.col("budget_usd"),
        "clicks_gt_impressions": F.col("clicks") > F.col("impressions"),
        "end_before_start": F.col("end_date") < F.col("start_date")}, "campaigns"))
    parts.append(AU.rule_counts(b["leads"], {
        "anonymous": F.col("customer_id").isNull(),
        "unattributed": F.col("campaign_id").isNull(),
        "impossible_dates": C.parse_date("conversion_date") < C.parse_date("lead_date")}, "leads"))
    parts.append(AU.rule_counts(t.leads, {
        "conversion_conflict": F.col("conversion_date").isNotNull() & ~F.col("converted_30d")}, "leads"))
    pages, tos = C.to_number("pages_viewed"), C.to_number("time_on_site_sec")
    parts.append(AU.rule_counts(b["sessions"], {
        "invalid_pages": pages <= 0, "invalid_time": (tos <= 0) | (tos > 86400)}, "sessions"))
    parts.append(AU.rule_counts(t.transactions, {
        "invalid_revenue": F.col("revenue_usd") <= 0, "invalid_units": F.col("units") <= 0}, "transactions"))
    parts.append(b["transactions"].agg(AU.dup_count(b["transactions"], "order_id").alias("duplicate_ids"))
                 .unpivot([], ["duplicate_ids"], "check_name", "n")
                 .select(F.lit("transactions").alias("table_name"), "check_name", "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_NULL_COLS = {
    "customers": ("age", "city", "gender", "income_band"),
    "leads": ("customer_id", "campaign_id", "conversion_date", "lead_score"),
    "sessions": ("customer_id", "pages_viewed", "time_on_site_sec", "session_date"),
}


def _null_sql():
    parts = []
    for tname, cols in _NULL_COLS.items():
        src = "b_customers" if tname == "customers" else tname
        for c in cols:
            parts.append(f"SELECT '{tname}' AS table_name, '{c}' AS column_name, "
                         f"CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM {src}")
    return " UNION ALL ".join(parts)


@register("null_counts", _null_sql(), group="audit")
def q_nulls(spark, sf_dir):
    t = tables(spark, sf_dir)
    srcs = {"customers": t.bronze["customers"], "leads": t.leads, "sessions": t.sessions}
    out = None
    for tname, cols in _NULL_COLS.items():
        part = AU.null_counts(srcs[tname], cols, tname)
        out = part if out is None else out.unionByName(part)
    return out


@register("match_rates", """
SELECT 'sessions_to_customers' AS relation, avg(CASE WHEN k.customer_id IS NULL THEN 0.0 ELSE 1.0 END) * 100 AS match_rate_pct,
       count(*) AS n_rows
FROM sessions s LEFT JOIN (SELECT DISTINCT customer_id FROM customers WHERE customer_id IS NOT NULL) k ON s.customer_id = k.customer_id
UNION ALL
SELECT 'sessions_to_campaigns', avg(CASE WHEN k.campaign_id IS NULL THEN 0.0 ELSE 1.0 END) * 100, count(*)
FROM sessions s LEFT JOIN (SELECT DISTINCT campaign_id FROM campaigns WHERE campaign_id IS NOT NULL) k ON s.campaign_id = k.campaign_id
UNION ALL
SELECT 'transactions_to_customers', avg(CASE WHEN k.customer_id IS NULL THEN 0.0 ELSE 1.0 END) * 100, count(*)
FROM transactions s LEFT JOIN (SELECT DISTINCT customer_id FROM customers WHERE customer_id IS NOT NULL) k ON s.customer_id = k.customer_id
UNION ALL
SELECT 'leads_to_campaigns', avg(CASE WHEN k.campaign_id IS NULL THEN 0.0 ELSE 1.0 END) * 100, count(*)
FROM leads s LEFT JOIN (SELECT DISTINCT campaign_id FROM campaigns WHERE campaign_id IS NOT NULL) k ON s.campaign_id = k.campaign_id
""", group="audit")
def q_match(spark, sf_dir):
    t = tables(spark, sf_dir)
    sessions, transactions, leads, customers, campaigns = t.sessions, t.transactions, t.leads, t.customers, t.campaigns
    return AU.match_rates({"sessions_to_customers": (sessions, "customer_id", customers, "customer_id"),
                           "sessions_to_campaigns": (sessions, "campaign_id", campaigns, "campaign_id"),
                           "transactions_to_customers": (transactions, "customer_id", customers, "customer_id"),
                           "leads_to_campaigns": (leads, "campaign_id", campaigns, "campaign_id")})


# --- checked CSV scan -----------------------------------------------------------
_EXPORTS = ("customers", "campaigns", "leads", "sessions", "transactions")


def _csv_sql(table: str) -> str:
    """One record in 256 lacks its last field, one has a field more."""
    cols = FI.RAW_COLUMNS[table]
    mark = f"substr(md5({cols[0]}), 1, 2)"
    chars = " + ".join(f"length(COALESCE({c}, ''))" for c in cols)
    return f"""SELECT '{table}' AS table_name, CAST(count_if({mark} NOT IN ('0a', '0b')) AS BIGINT) AS n_rows,
  CAST(count_if({mark} IN ('0a', '0b')) AS BIGINT) AS n_quarantined,
  CAST(sum(CASE WHEN {mark} NOT IN ('0a', '0b') THEN {chars} END) AS BIGINT) AS n_chars,
  count(DISTINCT CASE WHEN {mark} IN ('0a', '0b') THEN {cols[0]} END) AS n_quarantined_keys FROM b_{table}"""


@register("raw_csv_scan", " UNION ALL ".join(_csv_sql(n) for n in _EXPORTS), group="audit")
def q_csv_scan(spark, sf_dir):
    """SRC-01: the five exports written as CSV with some damaged records, then read
    back by the checked scan: good rows, their characters, and the quarantine."""
    t = tables(spark, sf_dir)

    def write(name):
        cols = FI.RAW_COLUMNS[name]
        mark = F.substring(F.md5(F.col(cols[0]).cast("binary")), 1, 2)
        FI.write_raw(t.export_table(name).select(*cols), f"{t.stage_root}/csv_{name}", F.when(mark == "0a", 1).when(mark == "0b", 2).otherwise(0))
    t.land(_EXPORTS, write)
    out = None
    for name in _EXPORTS:
        cols = FI.RAW_COLUMNS[name]
        rows = FI.scan_raw(spark, f"{t.stage_root}/csv_{name}", name)
        good = F.col(FI.BAD_RECORD).isNull()
        chars = sum((F.length(F.coalesce(F.col(c), F.lit(""))) for c in cols), F.lit(0).cast("bigint"))
        part = rows.agg(F.count_if(good).alias("n_rows"), F.count_if(~good).alias("n_quarantined"),
                        F.sum(F.when(good, chars)).alias("n_chars"),
                        F.countDistinct(F.when(~good, F.col(cols[0]))).alias("n_quarantined_keys")).select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@register("quality_scores", """
SELECT table_name, score, CASE WHEN score > 90 THEN 'Healthy' WHEN score > 70 THEN 'Warning' ELSE 'Critical' END AS status
FROM (
  SELECT 'customers' AS table_name, round((avg(CAST(COALESCE(age IS NOT NULL, false) AS DOUBLE))
     + avg(CAST(COALESCE(COALESCE(gender <> 'unknown', true), false) AS DOUBLE))) / 2 * 100, 1) AS score FROM customers
  UNION ALL SELECT 'campaigns', round((avg(CAST(COALESCE(budget_usd IS NOT NULL, false) AS DOUBLE))
     + avg(CAST(COALESCE(clicks <= impressions, false) AS DOUBLE))) / 2 * 100, 1) FROM campaigns
  UNION ALL SELECT 'leads', round((avg(CAST(COALESCE(customer_id IS NOT NULL, false) AS DOUBLE))
     + avg(CAST(COALESCE(lead_date <= COALESCE(conversion_date, DATE '9999-12-31'), false) AS DOUBLE))) / 2 * 100, 1) FROM leads
  UNION ALL SELECT 'sessions', round((avg(CAST(COALESCE(customer_id IS NOT NULL, false) AS DOUBLE))
     + avg(CAST(COALESCE(pages_viewed IS NOT NULL AND time_on_site_sec IS NOT NULL, false) AS DOUBLE))) / 2 * 100, 1) FROM sessions
  UNION ALL SELECT 'transactions', round((avg(CAST(COALESCE(revenue_usd > 0, false) AS DOUBLE))
     + avg(CAST(COALESCE(units > 0, false) AS DOUBLE))) / 2 * 100, 1) FROM transactions
) s""", group="audit")
def q_quality(spark, sf_dir):
    return AU.quality_scores(tables(spark, sf_dir).silver)
