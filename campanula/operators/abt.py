"""Analytical base table: one row per customer (JN-01, AGG-01..04, JN-09).

Each fact table is aggregated to customer grain *before* the joins (partial
+ final hash aggregate, map-side combine), so the left-join chain joins
three customer-grain tables that are all hash-partitioned on
``customer_id``; AQE broadcasts whichever side is measured small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campanula.functions import clean as C

COUNT_FILL = ("total_leads", "converted_leads", "total_acquisition_cost", "total_sessions",
              "total_add_to_cart", "total_checkout_started", "total_orders", "total_revenue",
              "total_units", "total_returned")


def scalar(df: DataFrame, agg: Column) -> Column:
    """JN-09 / WIN-11: a one-value aggregate usable in any row expression.

    Compiles to a scalar subquery evaluated once; no cross join and no
    driver round-trip.
    """
    return df.select(agg).scalar()


def leads_per_customer(leads: DataFrame) -> DataFrame:
    """AGG-01: lead count, conversions, mean score, total cost per customer."""
    return (leads.filter(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.count("lead_id").alias("total_leads"),
                 F.sum(F.col("converted_30d").cast("bigint")).alias("converted_leads"),
                 F.avg("lead_score").alias("avg_lead_score"),
                 F.coalesce(C.money_sum("acquisition_cost_usd"), F.lit(0.0)).alias("total_acquisition_cost")))


def sessions_per_customer(sessions: DataFrame) -> DataFrame:
    """AGG-02: session count, mean pages/time/engagement, cart/checkout sums."""
    return (sessions.filter(F.col("customer_id").isNotNull())
            .withColumn("engagement_score", C.engagement_score())
            .groupBy("customer_id")
            .agg(F.count("session_id").alias("total_sessions"),
                 F.avg("pages_viewed").alias("avg_pages_viewed"),
                 F.avg("time_on_site_sec").alias("avg_time_on_site"),
                 F.sum(F.col("add_to_cart").cast("bigint")).alias("total_add_to_cart"),
                 F.sum(F.col("checkout_started").cast("bigint")).alias("total_checkout_started"),
                 F.avg("engagement_score").alias("avg_engagement_score")))


def tx_per_customer(tx: DataFrame) -> DataFrame:
    """AGG-03: orders, revenue, units, returns, last order date per customer."""
    return (tx.filter(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.count("order_id").alias("total_orders"),
                 F.coalesce(C.money_sum("revenue_usd"), F.lit(0.0)).alias("total_revenue"),
                 F.coalesce(C.money_sum("units"), F.lit(0.0)).alias("total_units"),
                 F.sum(F.col("returned_flag").cast("bigint")).alias("total_returned"),
                 F.max("order_date").alias("last_order_date")))


def build_abt(customers: DataFrame, leads: DataFrame, sessions: DataFrame,
              tx: DataFrame) -> DataFrame:
    """JN-01 + AGG-04: customers left-joined with the three aggregates, KPIs."""
    abt = (customers
           .join(leads_per_customer(leads), "customer_id", "left")
           .join(sessions_per_customer(sessions), "customer_id", "left")
           .join(tx_per_customer(tx), "customer_id", "left"))
    abt = abt.na.fill(0, subset=list(COUNT_FILL))
    max_date = scalar(tx, F.max("order_date"))
    return abt.select(
        "*",
        C.safe_div("converted_leads", "total_leads").alias("LCR"),
        C.safe_div("total_acquisition_cost", "converted_leads").alias("CPA"),
        C.safe_div("total_revenue", "total_orders").alias("AOV"),
        C.safe_div("total_returned", "total_orders").alias("return_rate"),
        F.col("total_revenue").alias("CLV_proxy"),
        F.datediff(max_date, F.col("last_order_date")).cast("bigint").alias("recency_days"),
    )


def kpi_summary(abt: DataFrame) -> DataFrame:
    """AGG-27: the executive KPI row, ratio-of-sums definitions."""
    tl, cl = F.sum("total_leads"), F.sum("converted_leads")
    rev, orders = F.sum("total_revenue"), F.sum("total_orders")
    n = F.countDistinct("customer_id")
    return abt.agg(
        tl.cast("bigint").alias("total_leads"),
        cl.cast("bigint").alias("conversions"),
        F.when(tl > 0, cl / tl).otherwise(F.lit(0.0)).alias("lcr"),
        rev.alias("total_revenue"),
        orders.cast("bigint").alias("total_orders"),
        F.when(orders > 0, rev / orders).otherwise(F.lit(0.0)).alias("aov"),
        n.alias("total_customers"),
        F.avg((F.col("total_orders") > 1).cast("double")).alias("repeat_rate"),
        F.when(n > 0, rev / n).otherwise(F.lit(0.0)).alias("revenue_per_customer"),
        F.avg("AOV").alias("avg_customer_aov"),
    )
