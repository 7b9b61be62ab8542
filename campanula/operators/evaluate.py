"""Evaluation and scoring operators over a (label, score) table (EVA-*),
Kaplan-Meier survival (SUR-*) and the IPTW weighting step (CAU-01).

All of them aggregate first: by distinct score, by score-grid cell, by
distinct duration, so no single task ever sees the raw rows in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanula.functions import clean as C
from campanula.operators import ranks as RK
from campanula.operators.abt import scalar
from campanula.session import small

# --- fixed values -----------------------------------------------------------
COST_FN, COST_FP = 20.0, 5.0
THRESHOLDS = tuple(j * 0.01 for j in range(101))           # linspace(0, 1, 101)
CALIBRATION_EDGES = tuple(i * 0.1 for i in range(1, 10))   # inner edges of 10 uniform bins
PRIORITY_EDGES = (-0.001, 0.33, 0.66, 1.001)
PRIORITY_LABELS = ("Low", "Medium", "High")
# -----------------------------------------------------------------------------


def _count_below(x: Column, edges, strict: bool) -> Column:
    """Number of edges e with e < x (strict) or e <= x."""
    terms = [((F.lit(e) < x) if strict else (F.lit(e) <= x)).cast("int") for e in edges]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def grid_cell(x: Column) -> Column:
    """Number of grid thresholds t_j = j * 0.01 (j = 0..100) with t_j <= x,
    exactly: the candidate floor(100 x) is corrected by one step either way
    using the same floating-point products as the thresholds."""
    c = F.least(F.greatest(F.floor(x * 100), F.lit(0)), F.lit(100))
    below = (c.cast("double") * 0.01 > x).cast("int")
    above = ((c + 1 <= 100) & ((c + 1).cast("double") * 0.01 <= x)).cast("int")
    return F.when(x < 0, F.lit(0)).otherwise(c + 1 - below + above).cast("int")


def binary_metrics(pred: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """EVA-01: accuracy, precision, recall, F1 at a threshold (0 on zero division)."""
    y = F.col(label).cast("boolean")
    p = F.col(score) >= threshold
    g = pred.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                 F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    return g.select("tp", "fp", "fn", "tn", ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def auc(pred: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """EVA-02: ROC AUC by the rank-sum identity (exact, ties averaged), one row
    per group of ``by``.

    The scores are counted by value and label, and one ordered pass gives the
    negatives below each value: every positive wins against those and half
    against the negatives of its own value.
    """
    s = F.col(score).cast("double")
    counts = (pred.filter(s.isNotNull() & ~F.isnan(s)).groupBy(*by, s.alias("_s"))
              .agg(F.count_if(F.col(label).cast("boolean")).alias("_p"), F.count_if(~F.col(label).cast("boolean")).alias("_q")))
    below = RK.prefix_sums(counts, [*by, "_s"], {"q": "_q"})
    sums = [F.sum("_p").alias("n_pos"), F.sum("_q").alias("n_neg"), F.min("_cum_before_q").alias("_start"),
            F.sum(F.col("_p") * (F.col("_cum_before_q") + F.col("_q") / 2.0)).alias("_wins")]
    g = below.groupBy(*by).agg(*sums) if by else below.agg(*sums)
    n1, n0 = F.coalesce("n_pos", F.lit(0)), F.coalesce("n_neg", F.lit(0))
    # the running sum goes on from group to group: its start is taken off once per positive
    return g.select(*by, n1.alias("n_pos"), n0.alias("n_neg"),
                    F.try_divide(F.col("_wins") - n1 * F.col("_start"), (n1 * n0).cast("double")).alias("auc"))


def confusion(pred: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """EVA-03: confusion matrix in long form."""
    return (pred.select(F.col(label).cast("int").alias("actual"),
                        (F.col(score) >= threshold).cast("int").alias("predicted"))
            .groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n")))


def roc_points(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """EVA-04: (fpr, tpr) at every distinct score used as a ">=" threshold."""
    y = F.col(label).cast("int")
    by = (pred.filter(F.col(score).isNotNull()).groupBy(score)
          .agg(F.sum(y).alias("_p"), F.sum(1 - y).alias("_n")))
    ps = RK.prefix_sums(by, [F.col(score).desc()], {"p": "_p", "n": "_n"})
    tp_all = scalar(by, F.sum("_p"))
    fp_all = scalar(by, F.sum("_n"))
    return ps.select(F.col(score).alias("threshold"),
                     F.try_divide(F.col("_cum_n"), fp_all.cast("double")).alias("fpr"),
                     F.try_divide(F.col("_cum_p"), tp_all.cast("double")).alias("tpr"))


def calibration(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """EVA-05: 10 uniform bins, mean predicted vs observed, empty bins absent."""
    b = _count_below(F.col(score), CALIBRATION_EDGES, strict=True)
    return (pred.filter(F.col(score).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.avg(score).alias("mean_predicted"), F.avg(F.col(label).cast("double")).alias("fraction_positive"),
                 F.count(F.lit(1)).alias("n")))


def cost_threshold(pred: DataFrame, label: str = "label", score: str = "score",
                   cost_fn: float = COST_FN, cost_fp: float = COST_FP) -> DataFrame:
    """EVA-06: cost of every threshold on the 0.00..1.00 grid in one pass.

    Each score is histogrammed to the number of grid thresholds it clears;
    FN/FP per threshold are then running sums over <= 102 cells.  The first
    minimum is flagged.
    """
    cell = grid_cell(F.col(score))  # number of thresholds t_j <= score
    y = F.col(label).cast("int")
    h = (pred.filter(F.col(score).isNotNull()).groupBy(cell.alias("cell"))
         .agg(F.sum(y).alias("_p"), F.sum(1 - y).alias("_n")))
    spark = pred.sparkSession
    grid = spark.createDataFrame([(j, float(t)) for j, t in enumerate(THRESHOLDS)], "j int, threshold double")
    g = grid.join(h, grid.j == h.cell, "left").na.fill(0, ["_p", "_n"])
    w_le = Window.orderBy("j").rowsBetween(Window.unboundedPreceding, 0)     # 101 rows
    neg_total = scalar(h, F.sum("_n"))
    # scores clearing exactly j thresholds are below threshold j (index j)
    g = g.select("j", "threshold",
                 F.sum("_p").over(w_le).alias("fn"),
                 (neg_total - F.sum("_n").over(w_le)).alias("fp"))
    g = g.withColumn("cost", F.col("fn") * cost_fn + F.col("fp") * cost_fp)
    g = small(g)  # 101 rows
    best = scalar(g, F.min_by("j", F.struct("cost", "j")))
    return g.select("threshold", F.col("fn").cast("bigint").alias("fn"), F.col("fp").cast("bigint").alias("fp"),
                    "cost", (F.col("j") == best).alias("is_optimal"))


def priority_tier(score: Column) -> Column:
    """EVA-07: Low / Medium / High on (-0.001, .33], (.33, .66], (.66, 1.001]."""
    return C.cut(score, PRIORITY_EDGES, PRIORITY_LABELS)


def decile_table(pred: DataFrame, key: str, label: str = "label", score: str = "score") -> DataFrame:
    """EVA-08: rank-first deciles of the score, rate and cumulative rate from
    the top decile down (the running sum is over 10 rows)."""
    d = RK.qcut_rank(pred.select(key, label, score), score, [key], 10, "decile")
    g = (d.filter(F.col("decile").isNotNull()).groupBy("decile")
         .agg(F.count(F.lit(1)).alias("count"), F.sum(F.col(label).cast("bigint")).alias("conversions")))
    top = Window.orderBy(F.col("decile").desc()).rowsBetween(Window.unboundedPreceding, 0)  # 10 rows
    return g.select("decile", "count", "conversions", (F.col("conversions") / F.col("count")).alias("conversion_rate"),
                    (F.sum("conversions").over(top) / F.sum("count").over(top)).alias("cumulative_rate"))


def tier_stats(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """EVA-09: per priority tier n, conversions, rate and share of rows."""
    g = (pred.withColumn("priority_tier", priority_tier(F.col(score)))
         .filter(F.col("priority_tier").isNotNull()).groupBy("priority_tier")
         .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("conversions")))
    g = small(g)  # one row per tier
    tot = scalar(g, F.sum("n"))
    return g.select("priority_tier", "n", "conversions", (F.col("conversions") / F.col("n")).alias("rate"),
                    F.round(F.col("n") / tot * 100, 1).alias("share_pct"))


def project_clv(df: DataFrame, prob: str = "prob_repeat_90d") -> DataFrame:
    """EVA-10: orders_6m = 2p; CLV_6m = revenue + AOV * orders_6m (AOV's zero
    order count replaced by 1)."""
    aov = F.col("total_revenue") / F.when(F.col("total_orders") == 0, F.lit(1)).otherwise(F.col("total_orders"))
    orders = F.col(prob) * 2
    return df.select("*", orders.alias("projected_orders_6m"),
                     (F.col("total_revenue") + aov * orders).alias("projected_clv_6m"))


def covariate_balance(df: DataFrame, treat: str, nums: Sequence[str], cats: Sequence[str], weight: str | None = None) -> DataFrame:
    """CAU-01: is the treated group like the control group?  One row a number
    and one a level of each category: (weighted) means or shares of both
    groups and their standardised difference, the gap over the root of the
    mean of both variances (null without spread or with one group empty).

    Rows are reduced to sums a group and level before anything meets; a level
    that one group lacks counts as share 0 there.  Null numbers are left out
    of their own row, a null level is the level ``unknown``."""
    w = F.col(weight) if weight else F.lit(1.0)
    base = df.filter(F.col(treat).isNotNull()).select("*", F.col(treat).cast("double").alias("_t"), w.cast("double").alias("_bw"))
    one, zero = F.col("_t") == 1, F.col("_t") == 0

    def sums(rows):
        return rows.groupBy("covariate", "level").agg(*[
            F.sum(F.when(side, expr)).alias(f"{name}{k}") for k, side in (("1", one), ("0", zero))
            for name, expr in (("w", F.col("_bw")), ("x", F.col("_bw") * F.col("_x")), ("q", F.col("_bw") * F.col("_x") * F.col("_x")))])

    out = []
    if nums:
        long = base.select("_t", "_bw", F.explode(F.array(*[F.struct(F.lit(c).alias("covariate"), F.col(c).cast("double").alias("_x")) for c in nums])).alias("v"))
        out.append(sums(long.select("_t", "_bw", "v.*", F.lit(None).cast("string").alias("level")).filter(F.col("_x").isNotNull())))
    if cats:
        totals = small(base.agg(*[F.sum(F.when(side, F.col("_bw"))).alias(f"t{k}") for k, side in (("1", one), ("0", zero))]))
        long = base.select("_t", "_bw", F.explode(F.array(*[
            F.struct(F.lit(c).alias("covariate"), F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("level")) for c in cats])).alias("v"))
        levels = sums(long.select("_t", "_bw", "v.*", F.lit(1.0).alias("_x")))
        out.append(levels.select("covariate", "level", *[
            e.alias(f"{name}{k}") for k in "10" for name, e in
            (("w", scalar(totals, F.first(f"t{k}"))), ("x", F.coalesce(f"x{k}", F.lit(0.0))), ("q", F.coalesce(f"q{k}", F.lit(0.0))))]))
    rows = out[0] if len(out) == 1 else out[0].unionByName(out[1])
    means = rows.select("covariate", "level", *[c for k in "10" for c in (
        C.safe_div(f"x{k}", f"w{k}").alias(f"m{k}"), C.safe_div(f"q{k}", f"w{k}").alias(f"s{k}"))])
    spread = F.sqrt(F.greatest((F.col("s1") - F.col("m1") * F.col("m1") + F.col("s0") - F.col("m0") * F.col("m0")) / 2, F.lit(0.0)))
    known = F.col("m1").isNotNull() & F.col("m0").isNotNull()
    return means.select("covariate", "level", F.col("m1").alias("treated_mean"), F.col("m0").alias("control_mean"),
                        F.when(known, C.safe_div(F.col("m1") - F.col("m0"), spread)).alias("std_diff"))


def loss_making(clv: DataFrame) -> DataFrame:
    """EVA-11: share of customers whose acquisition cost exceeds projected CLV."""
    return clv.agg(F.avg((F.col("total_acquisition_cost") > F.col("projected_clv_6m")).cast("double"))
                   .alias("loss_making_share"), F.count(F.lit(1)).alias("n"))


def iptw_ate(df: DataFrame, treat: str, y: str, ps: str, clip: float = 1e-6) -> DataFrame:
    """CAU-01 weighting step: w = t/ps + (1-t)/(1-ps), ps clipped, and the
    self-normalised difference of weighted outcome means."""
    p = F.least(F.greatest(F.col(ps), F.lit(clip)), F.lit(1 - clip))
    t = F.col(treat).cast("double")
    w = t / p + (1 - t) / (1 - p)
    yy = F.col(y).cast("double")
    g = df.filter(F.col(ps).isNotNull() & F.col(y).isNotNull()).select(t.alias("_t"), w.alias("_w"), yy.alias("_y")) \
          .agg(F.sum(F.col("_t") * F.col("_w") * F.col("_y")).alias("a"), F.sum(F.col("_t") * F.col("_w")).alias("b"),
               F.sum((1 - F.col("_t")) * F.col("_w") * F.col("_y")).alias("c"),
               F.sum((1 - F.col("_t")) * F.col("_w")).alias("d"), F.count(F.lit(1)).alias("n"))
    mt, mc = F.try_divide(F.col("a"), F.col("b")), F.try_divide(F.col("c"), F.col("d"))
    return g.select("n", mt.alias("treated_mean"), mc.alias("control_mean"), (mt - mc).alias("ate"))


def kaplan_meier(df: DataFrame, t: str, e: str, by: str | None = None) -> DataFrame:
    """SUR-01 / SUR-02: survival table per distinct time (and group).

    At-risk = rows with time >= t; S(t) = prod over event times <= t of
    (1 - d/n), computed as exp of a running sum of logs (0 once d = n).
    Ungrouped: the distinct-time table is size-checked; within the bound it
    is ordered by one window task, beyond it by range-partitioned prefix
    sums.  Grouped: a window partitioned by group over the (group, time)
    aggregate (distinct times are bounded by the span of the dates).
    """
    keys = [by] if by else []
    agg = (df.filter(F.col(t).isNotNull() & F.col(e).isNotNull())
           .groupBy(*keys, t).agg(F.sum(F.col(e).cast("bigint")).alias("events"),
                                  F.count(F.lit(1)).alias("_m")))
    if by:
        total = Window.partitionBy(by)
        run = Window.partitionBy(by).orderBy(t).rowsBetween(Window.unboundedPreceding, 0)
        a = agg.withColumn("_N", F.sum("_m").over(total)) \
               .withColumn("_before", F.sum("_m").over(run) - F.col("_m"))
        a = a.withColumn("n_at_risk", F.col("_N") - F.col("_before"))
        a = a.withColumn("_log", F.when(F.col("events") < F.col("n_at_risk"),
                                        F.log1p(-F.col("events") / F.col("n_at_risk"))).otherwise(F.lit(0.0))) \
             .withColumn("_zero", (F.col("events") >= F.col("n_at_risk")).cast("int"))
        a = a.withColumn("_sl", F.sum("_log").over(run)).withColumn("_sz", F.sum("_zero").over(run))
    else:
        a = RK.prefix_sums(agg, [t], {"m": "_m"})
        n_all = scalar(a, F.sum("_m"))
        a = a.withColumn("n_at_risk", n_all - F.col("_cum_before_m"))
        a = a.withColumn("_log", F.when(F.col("events") < F.col("n_at_risk"),
                                        F.log1p(-F.col("events") / F.col("n_at_risk"))).otherwise(F.lit(0.0))) \
             .withColumn("_zero", (F.col("events") >= F.col("n_at_risk")).cast("int"))
        a = RK.prefix_sums(a.select(t, "events", "_m", "n_at_risk", "_log", "_zero"), [t],
                           {"sl": "_log", "sz": "_zero"})
        a = a.withColumnRenamed("_cum_sl", "_sl").withColumnRenamed("_cum_sz", "_sz")
    surv = F.when(F.col("_sz") > 0, F.lit(0.0)).otherwise(F.exp(F.col("_sl")))
    return a.select(*keys, F.col(t).alias("time"), F.col("n_at_risk").cast("bigint").alias("n_at_risk"),
                    F.col("events").cast("bigint").alias("events"),
                    (F.col("_m") - F.col("events")).cast("bigint").alias("censored"), surv.alias("survival"))


def km_summary(table: DataFrame, by: str | None = None) -> DataFrame:
    """SUR-01: n, events and median survival time (null = never reaches 0.5)."""
    keys = [by] if by else []
    return table.groupBy(*keys).agg(
        F.sum(F.col("events") + F.col("censored")).cast("bigint").alias("n"),
        F.sum("events").cast("bigint").alias("n_events"),
        F.min(F.when(F.col("survival") <= 0.5, F.col("time"))).alias("median_time"))
