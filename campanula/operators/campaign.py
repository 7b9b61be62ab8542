"""Campaign analytics (CMP-01 .. CMP-08, AGG-23/24/25/31).

Campaign-grain tables are small next to the lead and transaction facts, but
they are reused several times inside one job (medians, min/max
normalisation), so ``campaign_features`` and the per-channel table are
checkpointed once (the reference persists both as stage files) and every
scalar is then read from the small table rather than recomputed from the
facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campanula.functions import clean as C
from campanula.operators import ranks as RK
from campanula.operators.abt import scalar
from campanula.session import materialize, small

# --- fixed values: budget composite weights -----------------------------------
COMPOSITE_WEIGHTS = {"avg_roas": 0.35, "avg_lcr": 0.25, "avg_ltv": 0.25, "avg_repeat_rate": 0.15}
MARGIN_RATE = 0.30
# -----------------------------------------------------------------------------


def campaign_rollup(leads: DataFrame, tx: DataFrame) -> DataFrame:
    """AGG-23: per campaign, leads, conversions and the *whole* revenue of each
    lead's customer (any-touch; a customer's revenue counts once per lead)."""
    cust_rev = tx.filter(F.col("customer_id").isNotNull()).groupBy("customer_id") \
                 .agg(C.money_sum("revenue_usd").alias("_rev"))
    lr = (leads.filter(F.col("customer_id").isNotNull())
          .join(cust_rev, "customer_id", "left"))
    return (lr.filter(F.col("campaign_id").isNotNull()).groupBy("campaign_id")
            .agg(F.count("lead_id").alias("total_leads"),
                 F.sum(F.col("converted_30d").cast("bigint")).alias("converted_leads"),
                 F.coalesce(C.money_sum("_rev"), F.lit(0.0)).alias("total_revenue")))


def campaign_features(campaigns: DataFrame, leads: DataFrame, tx: DataFrame,
                      checkpoint: bool = True) -> DataFrame:
    """CMP-01 + CMP-02: LCR, CPA, ROAS, budget utilisation, p99 spend anomaly.

    Only the additive roll-up metrics are zero-filled; a removed (negative)
    spend stays null (defect D3).
    """
    f = campaigns.join(campaign_rollup(leads, tx), "campaign_id", "left") \
                 .na.fill(0, ["total_leads", "converted_leads", "total_revenue"])
    f = f.select(
        "*",
        C.safe_div0("converted_leads", "total_leads").alias("LCR"),
        F.when(F.col("converted_leads") > 0, F.col("spend_usd") / F.col("converted_leads"))
         .otherwise(F.lit(0.0)).alias("CPA"),
        C.safe_div0("total_revenue", "spend_usd").alias("ROAS"),
        C.safe_div("spend_usd", "budget_usd").alias("budget_utilization"),
    )
    if checkpoint:
        f = materialize(f)
    p99 = RK.quantile(f, "spend_usd", 0.99)
    return f.withColumn("spend_anomaly", F.coalesce(F.col("spend_usd") > p99, F.lit(False)))


def campaign_downstream(leads: DataFrame, abt: DataFrame) -> DataFrame:
    """AGG-24: mean customer LTV and repeat share of each campaign's leads."""
    lq = (leads.filter(F.col("customer_id").isNotNull())
          .join(abt.select("customer_id", "CLV_proxy", "total_orders"), "customer_id", "left"))
    rep = (F.coalesce(F.col("total_orders"), F.lit(0)) >= 2).cast("double")
    return (lq.filter(F.col("campaign_id").isNotNull()).groupBy("campaign_id")
            .agg(F.avg("CLV_proxy").alias("avg_customer_ltv"), F.avg(rep).alias("repeat_rate")))


def campaign_quality(features: DataFrame, leads: DataFrame, abt: DataFrame) -> DataFrame:
    """CMP-06: deceptive efficiency = ROAS above median while the repeat rate
    (null -> 0 for the median) is below median and known."""
    q = features.join(campaign_downstream(leads, abt), "campaign_id", "left")
    q = materialize(q)
    both = q.select(F.explode(F.array(F.struct(F.lit("roas").alias("f"), F.col("ROAS").cast("double").alias("x")),
                                      F.struct(F.lit("repeat").alias("f"), F.coalesce(F.col("repeat_rate"), F.lit(0.0)).alias("x")))).alias("v"))
    medians = small(RK.exact_quantiles(both.select("v.*"), "x", {"m": 0.5}, ["f"]))  # two rows, from one ordered pass
    roas_med, rr_med = (scalar(medians.filter(F.col("f") == f), F.first("m")) for f in ("roas", "repeat"))
    dec = ((F.col("ROAS") > roas_med)
           & (F.coalesce(F.col("repeat_rate"), F.lit(0.0)) < rr_med)
           & F.col("repeat_rate").isNotNull())
    return q.withColumn("deceptive_efficiency", F.coalesce(dec, F.lit(False)))


def budget_reallocation(quality: DataFrame) -> DataFrame:
    """CMP-07: per-channel composite score and recommended budget share."""
    ch = (quality.filter(F.col("channel").isNotNull()).groupBy("channel")
          .agg(F.coalesce(F.sum("spend_usd"), F.lit(0.0)).alias("total_spend"),
               F.avg("ROAS").alias("avg_roas"), F.avg("LCR").alias("avg_lcr"),
               F.avg("avg_customer_ltv").alias("avg_ltv"),
               F.avg("repeat_rate").alias("avg_repeat_rate")))
    ch = small(ch)  # one row per channel; every scalar below reads this
    comp = F.lit(0.0)
    for c, w in COMPOSITE_WEIGHTS.items():
        x = F.coalesce(F.col(c), F.lit(0.0))
        lo = scalar(ch, F.min(F.coalesce(F.col(c), F.lit(0.0))))
        hi = scalar(ch, F.max(F.coalesce(F.col(c), F.lit(0.0))))
        comp = comp + F.when(hi - lo > 0, (x - lo) / (hi - lo)).otherwise(F.lit(1.0)) * w
    ch = small(ch.withColumn("composite_score", F.bround(comp, 3)))
    tot_spend = scalar(ch, F.sum("total_spend"))
    tot_comp = scalar(ch, F.sum("composite_score"))
    denom = F.when(tot_spend == 0, F.lit(1.0)).otherwise(tot_spend)
    cur = F.bround(F.col("total_spend") / denom * 100, 1)
    rec = F.bround(F.col("composite_score") / tot_comp * 100, 1)
    return ch.select("*", cur.alias("current_budget_pct"), rec.alias("recommended_budget_pct"),
                     F.bround(rec - cur, 1).alias("budget_shift_pp"))


def channel_efficiency(features: DataFrame) -> DataFrame:
    """AGG-25: channel means of ROAS, LCR and spend."""
    return (features.filter(F.col("channel").isNotNull()).groupBy("channel")
            .agg(F.avg("ROAS").alias("ROAS"), F.avg("LCR").alias("LCR"), F.avg("spend_usd").alias("spend_usd")))


def margin_roas(features: DataFrame, rate: float = MARGIN_RATE) -> DataFrame:
    """CMP-02 variant + CMP-03 + CMP-04: anomaly (negative or > p99), clean and
    margin ROAS (null unless spend > 0), spend winsorised at p1..p99."""
    bounds = small(RK.exact_quantiles(features, "spend_usd", {"p01": 0.01, "p99": 0.99}))  # one row
    p99 = scalar(bounds, F.first("p99"))
    p01 = scalar(bounds, F.first("p01"))
    sp = F.col("spend_usd")
    ok = F.coalesce(sp > 0, F.lit(False)) & F.col("total_revenue").isNotNull()
    return features.select(
        "campaign_id", "channel", "spend_usd", "total_revenue",
        F.coalesce((sp < 0) | (sp > p99), F.lit(False)).alias("spend_anomaly_flag"),
        F.when(ok, F.col("total_revenue") / sp).alias("clean_roas"),
        F.when(ok, F.col("total_revenue") * rate / sp).alias("margin_roas"),
        C.clip(sp, p01, p99).alias("spend_wins"))


def roas_summary(cleaned: DataFrame) -> DataFrame:
    """CMP-05."""
    return cleaned.agg(F.avg("clean_roas").alias("mean_clean_roas"),
                       F.first(RK.quantile(cleaned, "clean_roas", 0.5)).alias("median_clean_roas"),
                       F.avg("margin_roas").alias("mean_margin_roas"),
                       F.count_if("spend_anomaly_flag").cast("bigint").alias("n_anomalies"))


def leads_per_campaign(campaigns: DataFrame, leads: DataFrame) -> DataFrame:
    """AGG-31: lead count per campaign joined back, 0 when none."""
    n = leads.filter(F.col("campaign_id").isNotNull()).groupBy("campaign_id") \
             .agg(F.count(F.lit(1)).alias("n_leads"))
    return campaigns.select("campaign_id", "spend_usd").join(n, "campaign_id", "left").na.fill(0, ["n_leads"])


def group_profile(features: DataFrame, group: str = "Group") -> DataFrame:
    """CMP-08: campaign group means and rank labels by mean ROAS."""
    prof = features.groupBy(group).agg(*[F.avg(c).alias(c) for c in
                                         ("spend_usd", "total_leads", "LCR", "ROAS", "CPA", "budget_utilization")])
    prof = small(prof)  # one row per group (k <= 5)
    from pyspark.sql import Window
    # WIN-07: ranking k group rows (k <= 5); the window sees k rows only.
    w = Window.orderBy(F.col("ROAS").desc_nulls_last(), F.col(group))
    return prof.withColumn("_r", F.row_number().over(w)).withColumn(
        "Group_Label", F.when(F.col("_r") == 1, "High Efficiency").when(F.col("_r") == 2, "Volume Drivers")
        .otherwise("Low ROI / Waste")).drop("_r")
