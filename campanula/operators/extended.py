"""Operators the reference promises in its plan or prints as constants but
never computes (tier P, SURVEY section 2.14), built on the same primitives."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanula.functions import clean as C
from campanula.functions.pvalues import p_value
from campanula.operators import ranks as RK
from campanula.operators.abt import scalar
from campanula.session import materialize, small


def linear_attribution(sessions: DataFrame, tx: DataFrame) -> DataFrame:
    """P-01: each customer's revenue split equally over their sessions' channels."""
    per = sessions.filter(F.col("customer_id").isNotNull()).groupBy("customer_id") \
                  .agg(F.count(F.lit(1)).alias("_n"))
    rev = tx.filter(F.col("customer_id").isNotNull()).groupBy("customer_id") \
            .agg(F.sum("revenue_usd").alias("_rev"))
    credit = per.join(rev, "customer_id").select("customer_id", (F.col("_rev") / F.col("_n")).alias("_c"))
    s = sessions.filter(F.col("channel_group").isNotNull()).join(credit, "customer_id")
    return s.groupBy(F.col("channel_group").alias("channel")).agg(F.sum("_c").alias("linear_revenue"),
                                                                 F.count(F.lit(1)).alias("sessions"))


def pareto_frontier(features: DataFrame) -> DataFrame:
    """P-02: campaigns not dominated on (lower spend, higher ROAS)."""
    d = features.filter(F.col("spend_usd").isNotNull()).select(
        "campaign_id", "channel", "spend_usd", F.coalesce(F.col("ROAS"), F.lit(0.0)).alias("ROAS"))
    m = RK.prefix_max_before(d, [F.col("spend_usd").asc(), F.col("ROAS").desc(), F.col("campaign_id").asc()],
                             "ROAS")
    return m.select("campaign_id", "channel", "spend_usd", "ROAS",
                    F.coalesce(F.col("ROAS") > F.col("_max_before"), F.col("_max_before").isNull())
                    .alias("on_frontier"))


def campaign_lifecycle(leads: DataFrame, campaigns: DataFrame, min_weeks: int = 3) -> DataFrame:
    """P-03: weekly conversion rate since launch and its trend per campaign
    (decay when the slope is negative, ramp-up when positive)."""
    j = leads.join(campaigns.select("campaign_id", "start_date"), "campaign_id") \
             .filter(F.col("lead_date").isNotNull() & F.col("start_date").isNotNull())
    wk = F.floor(F.datediff("lead_date", "start_date") / 7).cast("bigint")
    weekly = (j.withColumn("week", wk).filter(F.col("week") >= 0).groupBy("campaign_id", "week")
              .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("converted_30d").cast("double")).alias("rate")))
    g = weekly.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("weeks"),
        F.try_divide(F.covar_pop("rate", "week"), F.var_pop(F.col("week").cast("double"))).alias("slope"))
    ok = F.col("weeks") >= min_weeks
    return g.select("campaign_id", "weeks", F.when(ok, F.col("slope")).alias("slope"),
                    F.coalesce(ok & (F.col("slope") < 0), F.lit(False)).alias("decay"),
                    F.coalesce(ok & (F.col("slope") > 0), F.lit(False)).alias("ramp_up"))


def engagement_funnel(sessions: DataFrame, leads: DataFrame, tx: DataFrame) -> DataFrame:
    """P-04: distinct customers reaching each stage."""
    s = sessions.filter(F.col("customer_id").isNotNull()).agg(
        F.countDistinct("customer_id").alias("sessions"),
        F.countDistinct(F.when(F.col("add_to_cart"), F.col("customer_id"))).alias("add_to_cart"),
        F.countDistinct(F.when(F.col("checkout_started"), F.col("customer_id"))).alias("checkout"))
    conv = scalar(leads.filter(F.col("converted_30d")), F.countDistinct("customer_id"))
    orders = scalar(tx, F.countDistinct("customer_id"))
    wide = s.select("sessions", "add_to_cart", "checkout", conv.alias("converted_lead"), orders.alias("purchased"))
    stages = ["sessions", "add_to_cart", "checkout", "converted_lead", "purchased"]
    long = wide.unpivot([], stages, "stage", "customers")
    order = F.create_map(*[x for i, s_ in enumerate(stages) for x in (F.lit(s_), F.lit(i + 1))])
    return long.select(order[F.col("stage")].alias("step"), "stage", F.col("customers").cast("bigint"))


def outlier_impact(features: DataFrame) -> DataFrame:
    """P-07: campaign KPIs with and without flagged spend outliers."""
    p99 = RK.quantile(features, "spend_usd", 0.99)
    flag = F.coalesce((F.col("spend_usd") < 0) | (F.col("spend_usd") > p99), F.lit(False))
    keep = ~flag
    return features.agg(
        F.count_if(flag).cast("bigint").alias("n_flagged"),
        F.avg("ROAS").alias("mean_roas_all"), F.avg(F.when(keep, F.col("ROAS"))).alias("mean_roas_clean"),
        F.sum("spend_usd").alias("total_spend_all"), F.sum(F.when(keep, F.col("spend_usd"))).alias("total_spend_clean"),
        F.avg("LCR").alias("mean_lcr_all"), F.avg(F.when(keep, F.col("LCR"))).alias("mean_lcr_clean"))


def revenue_at_risk(rfm: DataFrame, abt: DataFrame, tier: str = "Champions") -> DataFrame:
    """P-10: revenue of the top tier that is not reachable by email."""
    j = rfm.filter(F.col("RFM_Tier") == tier).select("customer_id").join(
        abt.select("customer_id", "email_opt_in", "total_revenue"), "customer_id")
    return j.agg(F.count(F.lit(1)).alias("tier_customers"),
                 F.count_if(~F.col("email_opt_in")).cast("bigint").alias("not_opted_in"),
                 F.coalesce(F.sum(F.when(~F.col("email_opt_in"), F.col("total_revenue"))), F.lit(0.0))
                 .alias("revenue_at_risk"),
                 F.coalesce(F.sum("total_revenue"), F.lit(0.0)).alias("tier_revenue"))


def campaign_efficiency(features: DataFrame) -> DataFrame:
    """P-11: CTR and budget efficiency ratio = ROAS / (spend / budget)."""
    return features.select("campaign_id", "channel", C.safe_div("clicks", "impressions").alias("ctr"),
                           F.try_divide(F.col("ROAS"), C.safe_div("spend_usd", "budget_usd"))
                           .alias("budget_efficiency"))


def top_decile_outside_top_tier(clv: DataFrame, abt: DataFrame, top_tier: str = "platinum") -> DataFrame:
    """P-15: customers in the top projected-CLV decile who are not in the top
    loyalty tier (rank-first deciles)."""
    d = RK.qcut_rank(clv.select("customer_id", "projected_clv_6m"), "projected_clv_6m", ["customer_id"], 10, "decile")
    top = d.filter(F.col("decile") == 10).join(abt.select("customer_id", "loyalty_tier"), "customer_id")
    return top.agg(F.count(F.lit(1)).alias("top_decile_customers"),
                   F.count_if(F.coalesce(F.col("loyalty_tier") != top_tier, F.lit(True))).cast("bigint")
                   .alias("outside_top_tier"))


def loss_making_by_channel(clv: DataFrame, acq: DataFrame) -> DataFrame:
    """P-16: loss-making customers (acquisition cost > projected CLV) by
    acquisition channel."""
    j = clv.join(acq, "customer_id", "left").na.fill({"acquisition_channel": "(unattributed)"})
    loss = F.col("total_acquisition_cost") > F.col("projected_clv_6m")
    return j.groupBy("acquisition_channel").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(loss).cast("bigint").alias("loss_making"),
        F.avg(loss.cast("double")).alias("loss_share"),
        F.coalesce(F.sum(F.when(loss, F.col("total_acquisition_cost"))), F.lit(0.0)).alias("loss_spend"))


def landing_page_ranking(leads: DataFrame, abt: DataFrame, perf: DataFrame) -> DataFrame:
    """P-18: landing pages by LCR, customer AOV and bounce (equal values share a rank)."""
    lp = (leads.filter(F.col("landing_page").isNotNull())
          .join(abt.select("customer_id", "AOV"), "customer_id", "left")
          .groupBy("landing_page").agg(F.count("lead_id").alias("n_leads"),
                                       F.avg(F.col("converted_30d").cast("double")).alias("lcr"),
                                       F.avg("AOV").alias("avg_customer_aov")))
    t = materialize(lp.join(perf.select("landing_page", "bounce_rate"), "landing_page", "left"))
    # all metrics in one ordered pass over their distinct values, best first, missing last
    metrics = {"lcr": -F.col("lcr"), "aov": -F.col("avg_customer_aov"), "bounce": F.col("bounce_rate")}
    long = t.select("landing_page", F.explode(F.array(*[F.struct(F.lit(m).alias("m"), v.isNull().alias("none"), F.coalesce(v, F.lit(0.0)).alias("v"))
                                                      for m, v in metrics.items()])).alias("x")).select("landing_page", "x.*")
    values = RK.prefix_sum(long.groupBy("m", "none", "v").agg(F.count(F.lit(1)).alias("_n")), ["m", "none", "v"], "_n")
    pages = scalar(t, F.count(F.lit(1)))  # every page has a place in every metric, so a metric starts at a multiple
    ranked = long.join(values, ["m", "none", "v"]).withColumn("r", (F.col("_cum_before") % pages + 1).cast("bigint"))
    ranks = ranked.groupBy("landing_page").agg(*[F.max(F.when(F.col("m") == m, F.col("r"))).alias(f"rank_{m}") for m in metrics])
    return t.join(ranks, "landing_page")


def pairwise_welch_holm(df: DataFrame, group: str, value: str) -> DataFrame:
    """P-19: post-hoc Welch t-tests between all pairs of *groups* (categories,
    k of them: k(k-1)/2 rows from the k per-group summaries, never pairs of
    data rows) with Holm's step-down adjustment."""
    per = (df.filter(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group)
           .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v"))
           .filter(F.col("n") > 1))
    per = small(per)  # k groups
    a = per.select(*[F.col(c).alias(f"{c}_1") for c in (group, "n", "m", "v")])
    b = per.select(*[F.col(c).alias(f"{c}_2") for c in (group, "n", "m", "v")])
    pairs = a.join(b, F.col(f"{group}_1") < F.col(f"{group}_2"))
    sa, sb = F.col("v_1") / F.col("n_1"), F.col("v_2") / F.col("n_2")
    t = F.try_divide(F.col("m_1") - F.col("m_2"), F.sqrt(sa + sb))
    dof = F.try_divide((sa + sb) * (sa + sb), sa * sa / (F.col("n_1") - 1) + sb * sb / (F.col("n_2") - 1))
    tests = small(pairs.select(F.col(f"{group}_1").alias("group_1"), F.col(f"{group}_2").alias("group_2"),
                                     (F.col("m_1") - F.col("m_2")).alias("mean_diff"), t.alias("t"), dof.alias("df"))
                        .withColumn("p_value", p_value("t2", F.col("t"), F.col("df"))))
    m = scalar(tests, F.count(F.lit(1)))
    w = Window.orderBy("p_value", "group_1", "group_2")  # k(k-1)/2 rows
    step = tests.withColumn("_i", F.row_number().over(w)) \
                .withColumn("_adj", F.least(F.lit(1.0), (m - F.col("_i") + 1) * F.col("p_value")))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    return step.withColumn("p_holm", F.max("_adj").over(run)).drop("_i", "_adj") \
               .withColumn("significant", F.col("p_holm") < 0.05)


def kpi_slices(abt: DataFrame, key: str) -> DataFrame:
    """P-20: KPI row per slice with a traffic-light band on conversion
    (green: at or above the overall rate, amber: within 10 % below it)."""
    overall = scalar(abt, F.try_divide(F.sum("converted_leads"), F.sum("total_leads")))
    g = abt.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum("total_leads").cast("bigint").alias("total_leads"),
        F.sum("converted_leads").cast("bigint").alias("conversions"),
        F.sum("total_revenue").alias("revenue"), F.sum("total_orders").cast("bigint").alias("orders"))
    lcr = F.try_divide(F.col("conversions"), F.col("total_leads"))
    band = F.when(lcr >= overall, "green").when(lcr >= overall * 0.9, "amber").otherwise("red")
    return g.select(key, "total_leads", "conversions", lcr.alias("lcr"), "revenue",
                    F.try_divide(F.col("revenue"), F.col("orders")).alias("aov"), band.alias("band"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P-21: pairwise Pearson correlations of the given columns, one pass."""
    from campanula.operators.stats import safe_corr
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = x.agg(*[safe_corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    long = agg.unpivot([], [f"{a}__{b}" for a, b in pairs], "pair", "r")
    return long.select(F.split("pair", "__")[0].alias("x"), F.split("pair", "__")[1].alias("y"), "r")
