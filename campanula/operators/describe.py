"""Descriptive operators: group KPIs, windows, cohorts, RFM, attribution.

Conventions kept from the reference: group-bys drop null keys, ``count(col)``
counts non-nulls, sums of all-null are 0 where the reference fills, means
skip nulls.  Lookups against dimension tables are plain left joins; AQE
broadcasts a side only when its *measured* size is under the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanula.functions import clean as C
from campanula.operators import ranks as RK
from campanula.operators.abt import scalar


# Transaction rows have no unique key (order ids repeat), so ties on time
# are broken by the whole row.
TX_TIEBREAK = ("order_id", "product_category", "revenue_usd", "units", "discount_pct",
               "payment_type", "returned_flag", "marketing_channel_last_touch")


def _tb(tiebreak) -> list[str]:
    return [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)


def _sort_key(order: str, tiebreak, with_null_flag: bool = True) -> Column:
    parts = [F.col(order).isNull().alias("_n")] if with_null_flag else []
    parts.append(F.col(order).alias("_o"))
    parts += [F.col(t).alias(f"_t{i}") for i, t in enumerate(_tb(tiebreak))]
    return F.struct(*parts)


def lookup(fact: DataFrame, dim: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """JN-02: fact left-join dimension attributes on a key."""
    return fact.join(dim.select(key, *cols), key, "left")


def leads_with_campaign(leads: DataFrame, campaigns: DataFrame) -> DataFrame:
    return lookup(leads, campaigns, "campaign_id",
                  ["channel", "spend_usd", "objective", "budget_usd", "creative_type"])


def conversion_by(df: DataFrame, key: str, flag: str = "converted_30d", id_col: str = "lead_id") -> DataFrame:
    """AGG-05: n, conversions and rate per group (null keys dropped)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(id_col).alias("n_leads"),
                 F.sum(F.col(flag).cast("bigint")).alias("conversions"))
            .withColumn("lcr", F.col("conversions") / F.col("n_leads")))


def channel_conversion(leads: DataFrame, campaigns: DataFrame) -> DataFrame:
    """AGG-05 + AGG-06: channel conversion with true CPL (total channel spend
    over leads) and the reference's mean-spend-per-lead-row variant."""
    lc = leads_with_campaign(leads, campaigns)
    g = (lc.filter(F.col("channel").isNotNull()).groupBy("channel")
         .agg(F.count("lead_id").alias("n_leads"),
              F.sum(F.col("converted_30d").cast("bigint")).alias("conversions"),
              F.avg("spend_usd").alias("avg_spend_per_lead_row")))
    s = campaigns.filter(F.col("channel").isNotNull()).groupBy("channel") \
                 .agg(F.sum("spend_usd").alias("channel_spend"))
    return (g.join(s, "channel", "left")
            .select("channel", "n_leads", "conversions",
                    (F.col("conversions") / F.col("n_leads")).alias("lcr"),
                    "avg_spend_per_lead_row",
                    (F.col("channel_spend") / F.col("n_leads")).alias("cpl")))


DISCOUNT_EDGES = (-1, 0, 10, 15, 20, 100)
DISCOUNT_LABELS = ("0%", "1-10%", "11-15%", "16-20%", ">20%")


def discount_bracket(c: Column) -> Column:
    """CLN-19 on the lead discount (missing -> 0), reference brackets; a value
    outside all of them gets a bracket of its own."""
    return F.coalesce(C.cut(F.coalesce(c, F.lit(0.0)), DISCOUNT_EDGES, DISCOUNT_LABELS), F.lit("invalid"))


def value_by(abt: DataFrame, key: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """AGG-07: customers, mean / total revenue (+ extra means) per group."""
    aggs = [F.count("customer_id").alias("customers"),
            F.avg("total_revenue").alias("avg_revenue"),
            F.sum("total_revenue").alias("total_revenue")]
    for name, c in (extra or {}).items():
        aggs.append(c.alias(name))
    return abt.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def summary_by(df: DataFrame, key: str, val: str, stats: Sequence[str] = ("mean", "median", "count"),
               prefix: str = "") -> DataFrame:
    """AGG-08 / AGG-09: mean, median (exact), sample std, count per group."""
    fns = {"mean": F.avg, "std": F.stddev_samp, "count": F.count}
    known = df.filter(F.col(key).isNotNull())
    out = known.groupBy(key).agg(*[fns[s](val).alias(f"{prefix}{s}") for s in stats if s != "median"])
    if "median" in stats:
        out = out.join(RK.exact_quantiles(known, val, {f"{prefix}median": 0.5}, [key]), key, "left")
    return out.select(key, *[f"{prefix}{s}" for s in stats])


def mode_by(df: DataFrame, key: str, val: str, out: str) -> DataFrame:
    """AGG-10: most frequent value per key; smallest value on ties."""
    return (df.filter(F.col(key).isNotNull() & F.col(val).isNotNull())
            .groupBy(key).agg(F.mode(val, deterministic=True).alias(out)))


def acquisition_channel(leads: DataFrame, campaigns: DataFrame) -> DataFrame:
    lc = leads_with_campaign(leads, campaigns)
    return mode_by(lc, "customer_id", "channel", "acquisition_channel")


def channel_quality(abt: DataFrame, leads: DataFrame, campaigns: DataFrame) -> DataFrame:
    """AGG-11: customer quality by acquisition channel (modal lead channel)."""
    q = abt.join(acquisition_channel(leads, campaigns), "customer_id", "left") \
           .na.fill({"acquisition_channel": "(unattributed)"})
    g = q.groupBy("acquisition_channel").agg(
        F.count("customer_id").alias("n_customers"),
        F.avg("CLV_proxy").alias("avg_ltv"),
        F.avg("AOV").alias("avg_aov"),
        F.avg((F.col("total_orders") >= 2).cast("double")).alias("repeat_rate"),
        F.avg("total_acquisition_cost").alias("avg_acq_cost"))
    g = g.join(RK.exact_quantiles(q, "CLV_proxy", {"median_ltv": 0.5}, ["acquisition_channel"]), "acquisition_channel", "left")
    return g.withColumn("ltv_per_acq_cost", C.safe_div("avg_ltv", "avg_acq_cost"))


def first_by(df: DataFrame, key: str, order: str, tiebreak, cols: Sequence[str],
             prefix: str = "first_") -> DataFrame:
    """WIN-01: first row per key by time (nulls last, unique tiebreak).

    ``min_by`` over a struct sort key is a partial aggregate, so a key that
    holds a third of all rows is combined map-side instead of being sorted
    in one task as a ``row_number`` window would be.
    """
    sk = _sort_key(order, tiebreak)
    packed = F.struct(*[F.col(c).alias(c) for c in [order] + list(cols)])
    agg = (df.filter(F.col(key).isNotNull()).groupBy(key)
           .agg(F.min_by(packed, sk).alias("_first")))
    return agg.select(key, *[F.col(f"_first.{c}").alias(f"{prefix}{c}") for c in [order] + list(cols)])


def nth2_by(df: DataFrame, key: str, order: str, tiebreak, cols: Sequence[str] = ()) -> DataFrame:
    """WIN-02 / JN-08: first and second row per key, in one scan.

    ``row_number() <= 2`` is applied within each map task before the shuffle,
    so a key that holds a third of all rows sends two rows per task.  An exact
    duplicate of the first row is the second row.
    """
    sort = [order, *_tb(tiebreak)]
    more = [c for c in dict.fromkeys(cols) if c not in sort]
    # flat columns, each once: the rows are sorted as they are, so their width is what a task may spill
    w = Window.partitionBy(key).orderBy(F.col(order).isNull(), *sort)
    two = (df.filter(F.col(key).isNotNull()).select(*dict.fromkeys([key, *sort, *more]))
           .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 2))
    first = F.col("_rn") == 1
    out = two.groupBy(key).agg(F.max(F.when(first, F.struct(*[F.col(c).alias(c) for c in [order] + list(cols)]))).alias("_f"),
                               F.max(F.when(F.col("_rn") == 2, F.col(order))).alias(f"second_{order}"))
    return out.select(key, *[F.col(f"_f.{c}").alias(f"first_{c}") for c in [order] + list(cols)], f"second_{order}")


def last_by(df: DataFrame, key: str, order: str, tiebreak, val: str, out: str) -> DataFrame:
    """WIN-03: last non-null value per key by time."""
    sk = _sort_key(order, tiebreak, with_null_flag=False)
    return (df.filter(F.col(key).isNotNull() & F.col(val).isNotNull())
            .groupBy(key).agg(F.max_by(F.col(val), sk).alias(out)))


def repeat_target(tx: DataFrame, days: int = 90) -> DataFrame:
    """ML-19: first/second order per customer, days to second, repeat flag."""
    fs = nth2_by(tx, "customer_id", "order_date", TX_TIEBREAK, ["product_category", "payment_type"])
    d = F.datediff("second_order_date", "first_order_date").cast("bigint")
    return fs.select(
        "customer_id", "first_order_date", F.col("first_product_category").alias("product_category"),
        F.col("first_payment_type").alias("payment_type"), "second_order_date",
        d.alias("days_to_second"),
        C.flag((d <= days) & (d >= 0)).alias(f"repeat_{days}d"))


def category_stats(tx: DataFrame) -> DataFrame:
    """AGG-12 + AGG-13: category KPIs plus first-purchase repeat share."""
    stats = (tx.filter(F.col("product_category").isNotNull()).groupBy("product_category")
             .agg(F.count("order_id").alias("n_transactions"),
                  F.sum("revenue_usd").alias("total_revenue"),
                  F.avg("revenue_usd").alias("avg_revenue"),
                  F.avg(F.col("returned_flag").cast("double")).alias("return_rate"),
                  F.avg("discount_pct").alias("avg_discount")))
    return stats.join(gateway_repeat(tx), "product_category", "left")


def gateway_repeat(tx: DataFrame) -> DataFrame:
    """AGG-13: share of customers with >= 2 orders, by first-order category."""
    first = first_by(tx, "customer_id", "order_date", TX_TIEBREAK, ["product_category"])
    orders = tx.filter(F.col("customer_id").isNotNull()).groupBy("customer_id") \
               .agg(F.count(F.lit(1)).alias("order_count"))
    j = first.join(orders, "customer_id")
    return (j.filter(F.col("first_product_category").isNotNull())
            .groupBy(F.col("first_product_category").alias("product_category"))
            .agg(F.avg((F.col("order_count") >= 2).cast("double")).alias("first_purchase_repeat_rate")))


def return_rate_by(tx: DataFrame, key: str, out_key: str | None = None) -> DataFrame:
    """AGG-14: transactions, return rate, returns, mean revenue per group."""
    return (tx.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(out_key or key))
            .agg(F.count("order_id").alias("n_transactions"),
                 F.avg(F.col("returned_flag").cast("double")).alias("return_rate"),
                 F.sum(F.col("returned_flag").cast("bigint")).alias("total_returns"),
                 F.avg("revenue_usd").alias("avg_revenue")))


def flag_above_mean(df: DataFrame, c: str, out: str = "above_mean") -> DataFrame:
    """HIS-02: flag groups whose metric exceeds the mean over groups."""
    m = scalar(df, F.avg(c))
    return df.withColumn(out, F.coalesce(F.col(c) > m, F.lit(False)))


def attribution(tx: DataFrame, sessions: DataFrame) -> DataFrame:
    """AGG-15: revenue by last-touch vs by first-touch (earliest session)."""
    ft = first_by(sessions, "customer_id", "session_date", "session_id", ["channel_group"]) \
        .select("customer_id", F.col("first_channel_group").alias("first_touch_channel"))
    last = (tx.filter(F.col("marketing_channel_last_touch").isNotNull())
            .groupBy(F.col("marketing_channel_last_touch").alias("channel"))
            .agg(F.sum("revenue_usd").alias("last_touch_revenue")))
    first = (tx.join(ft, "customer_id", "left").filter(F.col("first_touch_channel").isNotNull())
             .groupBy(F.col("first_touch_channel").alias("channel"))
             .agg(F.sum("revenue_usd").alias("first_touch_revenue")))
    return outer_align(last, first, "channel")


def outer_align(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """JN-07: full outer join of two aggregates on their key, missing -> 0."""
    j = a.join(b, key, "full_outer")
    return j.na.fill(0.0, subset=[c for c in j.columns if c != key])


def landing_perf(sessions: DataFrame, leads: DataFrame) -> DataFrame:
    """AGG-16, every page, over the sessions x leads fan-out on customer, without
    materialising the pairs: a customer's sessions are counted once per
    matching lead, so every per-page total is sum over customers of
    (session aggregate x number of that customer's leads on the page)."""
    s = (sessions.filter(F.col("customer_id").isNotNull()).groupBy("customer_id")
         .agg(F.count("session_id").alias("s_n"),
              F.sum(F.col("bounce").cast("bigint")).alias("s_bounce"),
              F.sum("pages_viewed").alias("s_pages"),
              F.count("pages_viewed").alias("s_pages_n")))
    lp = (leads.filter(F.col("customer_id").isNotNull() & F.col("landing_page").isNotNull())
          .groupBy("customer_id", "landing_page").agg(F.count(F.lit(1)).alias("l_n")))
    j = lp.join(s, "customer_id")
    g = j.groupBy("landing_page").agg(
        F.sum(F.col("s_n") * F.col("l_n")).alias("sessions"),
        F.sum(F.col("s_bounce") * F.col("l_n")).alias("_b"),
        F.sum(F.col("s_pages") * F.col("l_n")).alias("_p"),
        F.sum(F.col("s_pages_n") * F.col("l_n")).alias("_pn"))
    out = g.select("landing_page", F.col("sessions").cast("bigint").alias("sessions"),
                   (F.col("_b") / F.col("sessions")).alias("bounce_rate"),
                   C.safe_div("_p", "_pn").alias("avg_pages"))
    return out


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """TOP-02: ``orderBy().limit(k)`` -> TakeOrderedAndProject (a per-partition
    top-k merged on one task: only k rows per partition move)."""
    return df.orderBy(*order).limit(k)


def cohort_retention(tx: DataFrame, customers: DataFrame, months: int = 12) -> DataFrame:
    """AGG-17 (long form): distinct buyers per signup month x months since.

    ``retained_vs_m0`` is the reference's ratio to month-0 buyers;
    ``retained_vs_cohort`` divides by the cohort's size (defect D10).
    """
    cust = customers.filter(F.col("signup_date").isNotNull()) \
        .select("customer_id", F.trunc("signup_date", "MM").alias("cohort_month"))
    j = tx.filter(F.col("order_date").isNotNull()).select("customer_id", "order_date").join(cust, "customer_id")
    j = j.withColumn("period", C.month_diff(F.trunc("order_date", "MM"), F.col("cohort_month")))
    counts = (j.filter((F.col("period") >= 0) & (F.col("period") < months))
              .groupBy("cohort_month", "period").agg(F.countDistinct("customer_id").alias("buyers")))
    m0 = counts.filter(F.col("period") == 0).select("cohort_month", F.col("buyers").alias("_m0"))
    size = cust.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    return (counts.join(m0, "cohort_month", "left").join(size, "cohort_month", "left")
            .select("cohort_month", "period", "buyers", "cohort_size",
                    C.safe_div("buyers", "_m0").alias("retained_vs_m0"),
                    C.safe_div("buyers", "cohort_size").alias("retained_vs_cohort")))


def cohort_matrix(long: DataFrame, months: int = 12, value: str = "retained_vs_m0") -> DataFrame:
    """AGG-17 display form: one column per month since signup."""
    return (long.groupBy("cohort_month").pivot("period", list(range(months)))
            .agg(F.first(value)).select("cohort_month", *[F.col(str(i)).alias(f"m{i}") for i in range(months)]))


def rfm_scores(abt: DataFrame, q: int = 5) -> DataFrame:
    """WIN-04 + CLN-22: R (recency, reversed), F, M quintiles and the tier."""
    df = abt.select("customer_id", "recency_days", "total_orders", "total_revenue")
    df = RK.qcut_scores(df, {"R_score": ("recency_days", True), "F_score": ("total_orders", False),
                             "M_score": ("total_revenue", False)}, "customer_id", q)
    return df.withColumn("RFM_Tier", C.rfm_tier("R_score", "F_score", "M_score"))


def tier_summary(rfm: DataFrame, tier: str = "RFM_Tier") -> DataFrame:
    """AGG-18."""
    return rfm.groupBy(tier).agg(F.count("customer_id").alias("count"),
                                 F.avg("total_revenue").alias("avg_revenue"),
                                 F.sum("total_revenue").alias("total_revenue"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """AGG-19: long-form contingency table (rows with a null dropped)."""
    return (df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
            .groupBy(a, b).agg(F.count(F.lit(1)).alias("n")))


def optin_gap(df: DataFrame, segment: str, optin: str = "email_opt_in", top: str = "Champions") -> DataFrame:
    """AGG-20: segment x opt-in counts with zero fill; gap = top segment not opted in."""
    p = (df.filter(F.col(segment).isNotNull()).groupBy(segment)
         .agg(F.count_if(F.col(optin)).alias("opted_in"),
              F.count_if(~F.col(optin)).alias("not_opted_in")))
    return p.withColumn("is_gap_segment", F.col(segment) == top)


def pivot_mean(df: DataFrame, row: str, col: str, val: str, values: Sequence[str] | None = None) -> DataFrame:
    """AGG-21: group means pivoted on the values of a category column, those
    that occur (sorted) unless given."""
    known = df.filter(F.col(row).isNotNull())
    if values is not None:
        return known.groupBy(row).pivot(col, list(values)).agg(F.avg(val))
    return known.filter(F.col(col).isNotNull()).groupBy(row).pivot(col).agg(F.avg(val)) \
        .join(known.select(row).distinct(), row, "right")


def uplift_by(df: DataFrame, key: str, treated: Column, y: str) -> DataFrame:
    """AGG-26: rate treated vs control per key, difference in points; keys
    lacking either arm dropped.  One grouped pass, no pivot."""
    t = F.coalesce(treated, F.lit(False))
    yy = F.col(y).cast("double")
    g = (df.filter(F.col(key).isNotNull()).groupBy(key)
         .agg(F.avg(F.when(~t, yy)).alias("no_discount"),
              F.avg(F.when(t, yy)).alias("discounted_lcr")))
    g = g.filter(F.col("no_discount").isNotNull() & F.col("discounted_lcr").isNotNull())
    return g.withColumn("uplift_pp", (F.col("discounted_lcr") - F.col("no_discount")) * 100)


def histogram(df: DataFrame, c: str, bins: int) -> DataFrame:
    """HIS-01: equal-width bins between min and max, last bin closed; empty
    bins kept (bin grid is ``range(bins)``, independent of the data size)."""
    lo = scalar(df, F.min(c).cast("double"))
    hi = scalar(df, F.max(c).cast("double"))
    width = (hi - lo) / bins
    x = F.col(c).cast("double")
    b = F.when(width > 0, F.least(F.floor((x - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = df.filter(F.col(c).isNotNull()).groupBy(b.cast("bigint").alias("bin")) \
               .agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return (grid.join(counts, "bin", "left").na.fill(0, ["n"])
            .select("bin", (lo + F.col("bin") * width).alias("lo"),
                    (lo + (F.col("bin") + 1) * width).alias("hi"), "n"))


def histograms(df: DataFrame, keys: Sequence[str], c: str, bins: int) -> DataFrame:
    """HIS-01 for every group of ``keys`` (categories) at once: one aggregate
    for the bounds, one for the bins; empty bins kept."""
    x = F.col(c).cast("double")
    known = df.filter(x.isNotNull())
    bounds = known.groupBy(*keys).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi")) \
                  .withColumn("_w", (F.col("_hi") - F.col("_lo")) / bins)
    b = F.when(F.col("_w") > 0, F.least(F.floor((x - F.col("_lo")) / F.col("_w")), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = (known.join(bounds, list(keys)).groupBy(*keys, b.cast("bigint").alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    grid = bounds.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))))
    return (grid.join(counts, [*keys, "bin"], "left").na.fill(0, ["n"])
            .select(*keys, "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("hi"), "n"))


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """TOP-04: deterministic sample of n rows without replacement."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    return df.orderBy(digest, F.col(key)).limit(n)


def id_list_blocks(df: DataFrame, key: str, per_block: int = 1000, sep: str = ", ") -> DataFrame:
    """AGG-30 for any number of ids: the distinct ids in order, cut into blocks
    of ``per_block`` (the last may be shorter).  The lists of the blocks, one
    after another, are the whole list; no task or row holds more than one
    block.  Null ids are left out; an empty table has no block."""
    from campanula.operators import ranks as RK
    ids = df.select(F.col(key).cast("string").alias("id")).filter(F.col("id").isNotNull()).distinct()
    at = RK.prefix_sum(ids, ["id"]).select("id", F.floor((F.col("_cum") - 1) / per_block).cast("bigint").alias("block"))
    return at.groupBy("block").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("n"),
                                   id_list("id", sep).alias("ids"))


def id_list(key: str, sep: str = ", ") -> Column:
    """AGG-30: aggregate expression collecting ids into one sorted delimited
    string (applied to a filtered, campaign-grain table)."""
    return F.array_join(F.array_sort(F.collect_list(F.col(key).cast("string"))), sep)
