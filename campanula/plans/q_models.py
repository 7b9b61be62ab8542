"""Model queries (ML-*, STA-11, CAU-01 with a fitted propensity, CMP-08).

Fitted models are seeded but not bit-reproducible across engines, so these
queries carry no oracle SQL (rows-only); their correctness is covered by
property tests (AUC above chance on a planted signal, cluster counts,
bootstrap interval containing the mean).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from campanula.functions import clean as C
from campanula.operators import campaign as CP
from campanula.operators import describe as D
from campanula.operators import evaluate as EV
from campanula.operators import ml as M
from campanula.operators import stats as S
from campanula.plans.registry import register, tables

G = "models"

# --- fixed values: the names of the three regressions -------------------------
MODEL_A = "A: Predict Customer LTV"
MODEL_B = "B: Predict Revenue/Transaction"
MODEL_C = "C: Predict Days-to-Convert"
# -----------------------------------------------------------------------------


def _lead_frame(t):
    if not hasattr(t, "_lead_frame"):
        from campanula.session import materialize
        t._lead_frame = materialize(M.lead_frame(t.leads, t.abt))
    return t._lead_frame


def _selected(t, name, build):
    """The comparison and its stored model, fitted once a session and folder."""
    if name not in t.selections:
        t.selections[name] = build()
    return t.selections[name]


def _lead_selection(t):
    return _selected(t, "lead", lambda: M.select_model(_lead_frame(t), M.LEAD_NUM, M.LEAD_CAT, "lead_id"))


@register("lead_model_comparison", None, group=G)
def q_lead_models(spark, sf_dir):
    return _lead_selection(tables(spark, sf_dir)).table


@register("lead_scores_model", None, group=G)
def q_lead_scores_model(spark, sf_dir):
    """EVA-07: every lead scored by the selected model; ``holdout`` marks leads it has not seen."""
    t = tables(spark, sf_dir)
    return M.score_selected(_lead_selection(t), _lead_frame(t)).select("lead_id", "label", "predicted_prob", "priority_tier", "holdout")


@register("lead_tiers_model", None, group=G)
def q_lead_tiers_model(spark, sf_dir):
    """EVA-09 on the leads the selected model has not seen."""
    t = tables(spark, sf_dir)
    held = M.score_selected(_lead_selection(t), _lead_frame(t)).filter("holdout")
    return EV.tier_stats(held, "label", "predicted_prob")


def _retention_frame(t):
    if not hasattr(t, "_retention_frame"):
        from campanula.session import materialize
        t._retention_frame = materialize(M.retention_frame(t.repeat_target, t.abt))
    return t._retention_frame


def _retention_selection(t):
    models = {k: m for k, m in M.classifiers().items() if k in M.RETENTION_MODELS}
    return _selected(t, "retention", lambda: M.select_model(_retention_frame(t), M.RETENTION_NUM, M.RETENTION_CAT, "customer_id", models))


@register("retention_model_comparison", None, group=G)
def q_retention_models(spark, sf_dir):
    """ML-21/22: three models of a second order within 90 days."""
    return _retention_selection(tables(spark, sf_dir)).table


@register("retention_feature_importance", None, group=G)
def q_retention_importance(spark, sf_dir):
    return M.importance_table(_retention_frame(tables(spark, sf_dir)), M.RETENTION_NUM, M.RETENTION_CAT)


@register("retention_frame", """
SELECT a.customer_id, CAST(a.total_orders AS BIGINT) AS total_orders, CAST(r.repeat_90d AS DOUBLE) AS label,
  """+", ".join(f"COALESCE(CAST(a.{c} AS DOUBLE), 0.0) AS {c}" for c in M.RETENTION_NUM)+",\n  "
          + ", ".join(f"COALESCE({'r' if c in ('product_category', 'payment_type') else 'a'}.{c}, 'Unknown') AS {c}" for c in M.RETENTION_CAT) + """
FROM abt a JOIN repeat_target r ON a.customer_id = r.customer_id""", group=G)
def q_retention_frame(spark, sf_dir):
    """ML-21: the rows and features the retention models are fitted on."""
    return _retention_frame(tables(spark, sf_dir))


@register("lead_feature_importance", None, group=G)
def q_importance(spark, sf_dir):
    return M.importance_table(_lead_frame(tables(spark, sf_dir)), M.LEAD_NUM, M.LEAD_CAT)


@register("lead_permutation_importance", None, group=G)
def q_perm(spark, sf_dir):
    return M.permutation_importance(_lead_frame(tables(spark, sf_dir)), M.LEAD_NUM, M.LEAD_CAT, "lead_id",
                                    [*M.LEAD_NUM, *M.LEAD_CAT])


@register("lead_split_sizes", """
SELECT part, label, CAST(CASE WHEN part = 'train' THEN floor(n * 0.75) ELSE n - floor(n * 0.75) END AS BIGINT) AS n
FROM (SELECT CAST(converted_30d AS DOUBLE) AS label, count(*) AS n FROM leads GROUP BY 1) c CROSS JOIN (VALUES ('train'), ('test')) v(part)""", group=G)
def q_split(spark, sf_dir):
    train, test = M.stratified_split(_lead_frame(tables(spark, sf_dir)), "label", "lead_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))) \
                .groupBy("part", "label").agg(F.count(F.lit(1)).alias("n"))


@register("kmeans_sweep", None, group=G)
def q_sweep(spark, sf_dir):
    from campanula.session import materialize
    x = materialize(M.segment_matrix(tables(spark, sf_dir).abt))
    return M.kmeans_sweep(x, range(2, 9))


def _segments(t):
    if not hasattr(t, "_segments"):
        t._segments = M.segment_customers(t.abt)
    return t._segments


@register("customer_segments", None, group=G)
def q_segments(spark, sf_dir):
    return _segments(tables(spark, sf_dir)).select("customer_id", "Segment", "Segment_Name")


@register("segment_profile", None, group=G)
def q_seg_profile(spark, sf_dir):
    t = tables(spark, sf_dir)
    s = _segments(t).select("customer_id", "Segment_Name").join(t.abt, "customer_id")
    feats = list(M.SEGMENT_FEATURES) + ["avg_pages_viewed", "avg_time_on_site"]
    return s.groupBy("Segment_Name").agg(F.count(F.lit(1)).alias("n"),
                                         *[F.avg(c).alias(c) for c in feats],
                                         C.money_sum("total_revenue").alias("revenue_of_segment"),
                                         F.sum("total_orders").alias("orders_of_segment"), F.sum("total_sessions").alias("sessions_of_segment"))


@register("segment_optin_gap", None, group=G)
def q_seg_gap(spark, sf_dir):
    return D.optin_gap(_segments(tables(spark, sf_dir)), "Segment_Name")


@register("customer_pca", None, group=G)
def q_pca(spark, sf_dir):
    from campanula.session import materialize
    return M.pca_2d(materialize(M.segment_matrix(tables(spark, sf_dir).abt)))


@register("campaign_groups", None, group=G)
def q_camp_groups(spark, sf_dir):
    from campanula.plans.q_campaign import features
    t = tables(spark, sf_dir)
    f = features(t)
    g = M.group_campaigns(f)
    prof = CP.group_profile(f.join(g, "campaign_id"))
    return g.join(prof.select("Group", "Group_Label"), "Group")


def _mlr_inputs(t):
    """ML-14's three models: frame, y, numbers, key, categories."""
    from campanula.functions.clean import fill_median
    from campanula.plans.q_describe import converted_leads
    tx = fill_median(t.transactions.filter(F.col("revenue_usd").isNotNull()), ["units", "discount_pct"])
    tx = tx.withColumn("_k", F.concat_ws("|", "order_id", "product_category", "revenue_usd"))
    return {
        MODEL_A: (t.abt, "CLV_proxy", M.LTV_FEATURES, "customer_id", ()),
        MODEL_B: (tx, "revenue_usd", ("units", "discount_pct"), "_k",
                                           ("product_category", "marketing_channel_last_touch")),
        MODEL_C: (converted_leads(t), "days_to_convert", ("lead_score", "discount_offered_pct", "acquisition_cost_usd"),
                                       "lead_id", ("lead_source", "observed_region")),
    }


@register("mlr_results", None, group=G)
def q_mlr(spark, sf_dir):
    return S.union_all([M.mlr(df, y, num, name, key, cat) for name, (df, y, num, key, cat) in _mlr_inputs(tables(spark, sf_dir)).items()])


def _gram_sql(name: str, source: str, key: str, y: str, num, cat) -> str:
    """The sums of products, from one (row, column, value) table joined with itself."""
    known = " AND ".join(f'"{c}" IS NOT NULL' for c in (y, *num))
    cells = " UNION ALL ".join(
        [f"SELECT r, part, '{n}' AS c, CAST({e} AS DOUBLE) AS v FROM rows_" for n, e in [("1", "1"), ("y", f'"{y}"'), *((c, f'"{c}"') for c in num)]]
        + [f"SELECT r, part, '{c}_' || COALESCE({c}, 'Unknown'), 1.0 FROM rows_" for c in cat])
    return f"""SELECT '{name}' AS model, part, a, b, total FROM (
  WITH rows_ AS (SELECT *, row_number() OVER () AS r,
    CASE WHEN CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 10000 < 7500 THEN 'train' ELSE 'holdout' END AS part
    FROM ({source}) s WHERE {known}),
  cells AS ({cells})
  SELECT x.part, x.c AS a, z.c AS b, sum(x.v * z.v) AS total FROM cells x JOIN cells z ON x.r = z.r AND x.c <= z.c
  GROUP BY x.part, x.c, z.c HAVING abs(sum(x.v * z.v)) > 1e-6) g"""


_MLR_SQL = {
    MODEL_A: ("SELECT * FROM abt", "customer_id"),
    MODEL_B: ("""SELECT order_id || '|' || product_category || '|' || CAST(revenue_usd AS VARCHAR) AS _k, revenue_usd,
      COALESCE(units, (SELECT median(units) FROM transactions WHERE revenue_usd IS NOT NULL)) AS units,
      COALESCE(discount_pct, (SELECT median(discount_pct) FROM transactions WHERE revenue_usd IS NOT NULL)) AS discount_pct,
      product_category, marketing_channel_last_touch FROM transactions WHERE revenue_usd IS NOT NULL""", "_k"),
    MODEL_C: ("SELECT * FROM converted_leads", "lead_id"),
}
_MLR_COLUMNS = {
    MODEL_A: ("CLV_proxy", M.LTV_FEATURES, ()),
    MODEL_C: ("days_to_convert", ("lead_score", "discount_offered_pct", "acquisition_cost_usd"), ("lead_source", "observed_region")),
}


@register("mlr_gram_sums", " UNION ALL ".join(_gram_sql(n, *_MLR_SQL[n], *c) for n, c in _MLR_COLUMNS.items()), group=G)
def q_mlr_sums(spark, sf_dir):
    """ML-14's Gram sums of models A and C, train and holdout: what the fits are solved from."""
    inputs = _mlr_inputs(tables(spark, sf_dir))
    return S.union_all([M.gram_table(df, y, num, name, key, cat) for name, (df, y, num, key, cat) in inputs.items() if name in _MLR_COLUMNS])


def _causal_frame(t):
    if not hasattr(t, "_causal_frame"):
        from campanula.session import materialize
        t._causal_frame = materialize(M.causal_frame(t.leads))
    return t._causal_frame


@register("discount_logit_table", None, group=G)
def q_logit(spark, sf_dir):
    return M.logit_table(_causal_frame(tables(spark, sf_dir)), "label", ["discount_pct", *M.CAUSAL_NUM], M.CAUSAL_CAT)


@register("iptw_discount_ate_logit", None, group=G)
def q_iptw_logit(spark, sf_dir):
    ps = M.propensity_scores(_causal_frame(tables(spark, sf_dir)), "treated", M.CAUSAL_NUM, M.CAUSAL_CAT)
    return EV.iptw_ate(ps, "treated", "label", "ps")


def _boot_sql(metric: str, source: str, value: str, key: str, n_boot: int = 2000, blocks: int = 1024) -> str:
    return f"""SELECT '{metric}' AS metric, (SELECT sum(x) / count(*) FROM (SELECT {value} AS x FROM {source}) v WHERE x IS NOT NULL) AS mean,
  quantile_cont(m, 0.025) AS ci_low, quantile_cont(m, 0.975) AS ci_high, CAST({n_boot} AS BIGINT) AS n_boot
FROM (SELECT r, sum(s) / sum(n) AS m
      FROM (SELECT r, CAST('0x' || substr(md5('42:' || r || ':' || d), 1 + 4 * k, 4) AS INTEGER) % {blocks} AS block
            FROM range({n_boot}) a(r), range({blocks // 8}) b(d), range(8) c(k)) draws
      JOIN (SELECT CAST('0x' || substr(md5({key} || ':42'), 1, 4) AS INTEGER) % {blocks} AS block, sum(x) AS s, count(*) AS n
            FROM (SELECT {key}, {value} AS x FROM {source}) v WHERE x IS NOT NULL GROUP BY 1) sums ON sums.block = draws.block
      GROUP BY r) means"""


@register("bootstrap_ci", " UNION ALL ".join([
    _boot_sql("customer_aov", "abt WHERE total_orders > 0", "total_revenue / total_orders", "customer_id"),
    _boot_sql("campaign_roas", "camp_features", '"ROAS"', "campaign_id")]), group=G)
def q_boot(spark, sf_dir):
    from campanula.plans.q_campaign import features
    t = tables(spark, sf_dir)
    cust = t.abt.filter(F.col("total_orders") > 0).withColumn("cust_aov", F.col("total_revenue") / F.col("total_orders"))
    aov = M.blocked_bootstrap_ci(cust, "cust_aov", "customer_id").withColumn("metric", F.lit("customer_aov"))
    roas = M.blocked_bootstrap_ci(features(t), "ROAS", "campaign_id").withColumn("metric", F.lit("campaign_roas"))
    return aov.unionByName(roas)


@register("clv_projection_model", None, group=G)
def q_clv_model(spark, sf_dir):
    """EVA-10 with the selected retention model, not the frequency table."""
    t = tables(spark, sf_dir)
    scored = M.score_selected(_retention_selection(t), _retention_frame(t))
    return EV.project_clv(scored.withColumnRenamed("predicted_prob", "prob_repeat_90d")) \
             .select("customer_id", "prob_repeat_90d", "projected_orders_6m", "projected_clv_6m")
