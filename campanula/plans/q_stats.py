"""Statistical test queries (STA-*): statistics with oracle SQL; p-values
in a separate rows-only query (the oracle has no distribution functions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from campanula.functions import clean as C
from campanula.operators import describe as D
from campanula.operators import stats as S
from campanula.plans.registry import oracle_body, register, tables
from campanula.plans.q_describe import aov_last_touch

G = "stats"

# --- group tests ------------------------------------------------------------------------------
_CONVERTED = "CAST(converted_30d AS INTEGER)"


def _lc(t):
    return D.leads_with_campaign(t.leads, t.campaigns)


def _lead_groups(t):
    """Leads with all the groups and values that the group tests take from them."""
    known = F.col("converted_30d") & F.col("conversion_date").isNotNull() & F.col("lead_date").isNotNull()
    return _lc(t).select("channel", F.col("converted_30d").cast("int").alias("conv_i"),
                         D.discount_bracket(F.col("discount_offered_pct")).alias("disc_bracket"),
                         F.when(known, C.days_between("conversion_date", "lead_date")).alias("days_to_convert"))


def _acq(t):
    return t.abt.join(D.acquisition_channel(t.leads, t.campaigns), "customer_id")


_BRACKET_SQL = """(SELECT *, CASE WHEN d > -1 AND d <= 0 THEN '0%' WHEN d > 0 AND d <= 10 THEN '1-10%'
   WHEN d > 10 AND d <= 15 THEN '11-15%' WHEN d > 15 AND d <= 20 THEN '16-20%' WHEN d > 20 AND d <= 100 THEN '>20%'
   ELSE 'invalid' END AS disc_bracket FROM (SELECT *, COALESCE(discount_offered_pct, 0.0) AS d FROM leads) x)"""

_ACQ_SQL = """(SELECT a.*, c.acquisition_channel FROM abt a LEFT JOIN acq_channel c ON a.customer_id = c.customer_id)"""

# each source is read once for all the tests on it
GROUP_SOURCES = {"leads": _lead_groups, "abt": lambda t: t.abt, "acquired": _acq, "last_touch": aov_last_touch}
GROUP_TESTS = {
    # name: (source, group, value, SQL with columns g, v)
    "channel_x_converted": ("leads", "channel", "conv_i", f"SELECT channel AS g, {_CONVERTED} AS v FROM leads_camp"),
    "region_x_revenue": ("abt", "region", "total_revenue", "SELECT region AS g, total_revenue AS v FROM abt"),
    "discount_bracket_x_converted": ("leads", "disc_bracket", "conv_i", f"SELECT disc_bracket AS g, {_CONVERTED} AS v FROM {_BRACKET_SQL} b"),
    "loyalty_tier_x_revenue": ("abt", "loyalty_tier", "total_revenue", "SELECT loyalty_tier AS g, total_revenue AS v FROM abt"),
    "acquisition_channel_x_ltv": ("acquired", "acquisition_channel", "CLV_proxy",
                                  f"SELECT acquisition_channel AS g, \"CLV_proxy\" AS v FROM {_ACQ_SQL} q"),
    "last_touch_channel_x_aov": ("last_touch", "channel", "cust_aov", "SELECT channel AS g, cust_aov AS v FROM aov_last_touch"),
    "loyalty_tier_x_ltv": ("abt", "loyalty_tier", "CLV_proxy", "SELECT loyalty_tier AS g, \"CLV_proxy\" AS v FROM abt"),
    "channel_x_days_to_convert": ("leads", "channel", "days_to_convert",
                                  "SELECT channel AS g, CAST(days_to_convert AS DOUBLE) AS v FROM converted_leads"),
}


def _kruskal_sql(name: str, src: str) -> str:
    return f"""SELECT '{name}' AS test,
  ((12.0 / (n * (n + 1))) * s - 3.0 * (n + 1)) / (1.0 - t / (n * n * n - n)) AS statistic,
  CAST(n AS BIGINT) AS n, 'chi2' AS dist, CAST(k - 1 AS DOUBLE) AS df1, CAST(NULL AS DOUBLE) AS df2
FROM (SELECT CAST(sum(n_g) AS DOUBLE) AS n, count(*) AS k, sum(r_g * r_g / n_g) AS s FROM (
        SELECT g, count(*) AS n_g, sum(rk) AS r_g FROM (
          SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk
          FROM ({_kept(src)}) b) r GROUP BY g) per) tot,
     (SELECT sum(CAST(c AS DOUBLE) * c * c - c) AS t FROM (SELECT count(*) AS c FROM ({_kept(src)}) b2 GROUP BY v) tv) ties"""


def _kept(src: str) -> str:
    return f"""SELECT g, v FROM ({src}) s0 WHERE g IS NOT NULL AND v IS NOT NULL AND g IN (
  SELECT g FROM ({src}) s1 WHERE g IS NOT NULL AND v IS NOT NULL GROUP BY g HAVING count(*) > 1)"""


def _anova_sql(name: str, src: str) -> str:
    return f"""SELECT '{name}' AS test, (ssb / (k - 1)) / (ssw / (n - k)) AS statistic, CAST(n AS BIGINT) AS n,
  'f' AS dist, CAST(k - 1 AS DOUBLE) AS df1, CAST(n - k AS DOUBLE) AS df2
FROM (SELECT sum(n_g) AS n, count(*) AS k,
        sum(n_g * (m_g - gm) * (m_g - gm)) AS ssb, sum((n_g - 1) * v_g) AS ssw
      FROM (SELECT g, count(*) AS n_g, avg(v) AS m_g, var_samp(v) AS v_g FROM ({_kept(src)}) b GROUP BY g) per,
           (SELECT sum(v) / count(*) AS gm FROM ({_kept(src)}) b2) grand) a"""


def _group_query(kind: str):
    names = list(GROUP_TESTS) if kind == "kruskal" else ["region_x_revenue", "loyalty_tier_x_revenue",
                                                          "acquisition_channel_x_ltv", "last_touch_channel_x_aov",
                                                          "loyalty_tier_x_ltv", "channel_x_days_to_convert"]
    sql = " UNION ALL ".join((_kruskal_sql if kind == "kruskal" else _anova_sql)(n, GROUP_TESTS[n][3])
                             for n in names)

    def run(spark, sf_dir):
        t = tables(spark, sf_dir)
        sources = {k: GROUP_SOURCES[k](t) for k in {GROUP_TESTS[n][0] for n in names}}
        tests = {n: (sources[GROUP_TESTS[n][0]], *GROUP_TESTS[n][1:3]) for n in names}
        return (S.kruskal_tests if kind == "kruskal" else S.anova_tests)(tests)
    return sql, run


for _kind in ("kruskal", "anova"):
    _sql, _run = _group_query(_kind)
    register(f"{_kind}_tests", _sql, group=G)(_run)


# --- chi-square: two-way tables, one scan a source ------------------------------
# test: (Spark column a, Spark column b, SQL a, SQL b); one source table for all of them
def _flag(c):
    return F.coalesce(F.col(c), F.lit(False))


LEAD_TABLES = {
    "channel_x_converted": ("channel", _flag, "channel"),
    "objective_x_converted": ("objective", _flag, "objective"),
    "landing_page_x_converted": ("landing_page", _flag, "landing_page"),
    "discounted_x_converted": (lambda: F.coalesce(F.col("discount_offered_pct") > 0, F.lit(False)), _flag,
                               "COALESCE(discount_offered_pct > 0, false)"),
}


def _chi2_sql(name: str, src: str) -> str:
    """All r x c cells as a dense grid; Yates' correction with one degree of freedom."""
    return f"""SELECT '{name}' AS test, chi2 AS statistic, CAST(n AS BIGINT) AS n, 'chi2' AS dist,
  CAST((nr - 1) * (nc - 1) AS DOUBLE) AS df1, CAST(NULL AS DOUBLE) AS df2,
  CASE WHEN least(nr, nc) > 1 THEN sqrt(chi2 / (n * (least(nr, nc) - 1))) END AS cramers_v
FROM (SELECT sum(pow(CASE WHEN nr = 2 AND nc = 2 THEN abs(o - e) - least(0.5, abs(o - e)) ELSE o - e END, 2) / e) AS chi2,
        max(n) AS n, max(nr) AS nr, max(nc) AS nc
      FROM (SELECT COALESCE(k.o, 0) AS o, ra.n * cb.n / tot.n AS e, tot.n, tot.nr, tot.nc
            FROM (SELECT a, CAST(count(*) AS DOUBLE) AS n FROM ({src}) s1 WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY a) ra
            CROSS JOIN (SELECT b, CAST(count(*) AS DOUBLE) AS n FROM ({src}) s2 WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY b) cb
            CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS n, count(DISTINCT a) AS nr, count(DISTINCT b) AS nc
                        FROM ({src}) s3 WHERE a IS NOT NULL AND b IS NOT NULL) tot
            LEFT JOIN (SELECT a, b, count(*) AS o FROM ({src}) s4 GROUP BY a, b) k ON k.a = ra.a AND k.b = cb.b) g) x"""


@register("chi2_tests", " UNION ALL ".join(
    _chi2_sql(n, f"SELECT {sql} AS a, COALESCE(converted_30d, false) AS b FROM leads_camp") for n, (_, _, sql) in LEAD_TABLES.items()), group=G)
def q_chi2(spark, sf_dir):
    t = tables(spark, sf_dir)
    pairs = {n: (a if isinstance(a, str) else a(), flag("converted_30d")) for n, (a, flag, _) in LEAD_TABLES.items()}
    return S.chi2_from_cells(S.contingency(_lc(t), pairs))


# general r x c tables: (source frame, {test: (a, b)}), {test: SQL with columns a, b}
def _unknown(c):
    return F.coalesce(F.col(c), F.lit("Unknown"))


def _lead_profile(t):
    return t.leads.join(t.abt.select("customer_id", "preferred_device"), "customer_id", "left")


def _repeat_profile(t):
    return t.abt.join(t.repeat_target.select("customer_id", "repeat_90d"), "customer_id")


TABLE_TESTS = [
    (lambda t: t.customers, {"income_band_x_loyalty_tier": ("income_band", "loyalty_tier"), "region_x_device": ("region", "preferred_device")}),
    (_lead_profile, {"device_x_converted": ("preferred_device", "converted_30d"),
                     "lead_source_x_converted": (lambda: _unknown("lead_source"), "converted_30d"),
                     "lead_source_x_landing_page": ("lead_source", "landing_page")}),
    (_repeat_profile, {"loyalty_tier_x_repeat_90d": (lambda: _unknown("loyalty_tier"), "repeat_90d")}),
    (lambda t: t.transactions, {"category_x_channel": ("product_category", "marketing_channel_last_touch")}),
]
TABLE_SQL = {
    "income_band_x_loyalty_tier": "SELECT income_band AS a, loyalty_tier AS b FROM customers",
    "region_x_device": "SELECT region AS a, preferred_device AS b FROM customers",
    "device_x_converted": "SELECT p.preferred_device AS a, l.converted_30d AS b FROM leads l LEFT JOIN abt p ON l.customer_id = p.customer_id",
    "lead_source_x_converted": "SELECT COALESCE(lead_source, 'Unknown') AS a, converted_30d AS b FROM leads",
    "lead_source_x_landing_page": "SELECT lead_source AS a, landing_page AS b FROM leads",
    "loyalty_tier_x_repeat_90d": "SELECT COALESCE(c.loyalty_tier, 'Unknown') AS a, r.repeat_90d AS b "
                                 "FROM abt c JOIN repeat_target r ON c.customer_id = r.customer_id",
    "category_x_channel": "SELECT product_category AS a, marketing_channel_last_touch AS b FROM transactions",
}


@register("chi2_table_tests", " UNION ALL ".join(_chi2_sql(n, s) for n, s in TABLE_SQL.items()), group=G)
def q_chi2_tables(spark, sf_dir):
    """STA-01 / STA-02 over general two-way tables: the cells of all tests in one table."""
    t = tables(spark, sf_dir)
    parts = [S.contingency(source(t), {n: tuple(c if isinstance(c, str) else c() for c in pair) for n, pair in pairs.items()})
             for source, pairs in TABLE_TESTS]
    return S.chi2_from_cells(S.union_all(parts))


# --- two-group tests ----------------------------------------------------------
TWO = {
    "mobile_vs_desktop_revenue": (
        lambda t: (t.abt.filter(F.col("preferred_device").isin("mobile", "desktop")),
                   F.col("preferred_device") == "mobile", "total_revenue"),
        "SELECT preferred_device = 'mobile' AS x, total_revenue AS v FROM abt WHERE preferred_device IN ('mobile', 'desktop')"),
    "converted_vs_not_lead_score": (
        lambda t: (t.leads, F.col("converted_30d"), "lead_score"),
        "SELECT converted_30d AS x, lead_score AS v FROM leads"),
    "repeat90_vs_not_revenue": (
        lambda t: (t.abt.join(t.repeat_target.select("customer_id", "repeat_90d"), "customer_id"),
                   F.col("repeat_90d") == 1, "total_revenue"),
        "SELECT r.repeat_90d = 1 AS x, a.total_revenue AS v FROM abt a JOIN repeat_target r ON a.customer_id = r.customer_id"),
}


def _mw_sql(name: str, src: str, alternative: str = "two-sided") -> str:
    u, dist = ("u1", "norm1") if alternative == "greater" else ("greatest(u1, n1 * n2 - u1)", "norm2")
    return f"""SELECT '{name}' AS test, u1 AS statistic, CAST(n1 + n2 AS BIGINT) AS n, '{dist}' AS dist,
  CAST(NULL AS DOUBLE) AS df1, CAST(NULL AS DOUBLE) AS df2,
  ({u} - n1 * n2 / 2.0 - 0.5)
    / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - t / ((n1 + n2) * (n1 + n2 - 1)))) AS z,
  n1, n2
FROM (SELECT r1 - n1 * (n1 + 1) / 2.0 AS u1, n1, n2, t FROM (
        SELECT sum(CASE WHEN x THEN rk END) AS r1, CAST(count_if(x) AS DOUBLE) AS n1,
               CAST(count_if(NOT x) AS DOUBLE) AS n2
        FROM (SELECT x, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk
              FROM ({src}) s WHERE x IS NOT NULL AND v IS NOT NULL) r) a,
      (SELECT sum(CAST(c AS DOUBLE) * c * c - c) AS t FROM (
         SELECT count(*) AS c FROM ({src}) s2 WHERE x IS NOT NULL AND v IS NOT NULL GROUP BY v) tv) b) z"""


def _welch_sql(name: str, src: str) -> str:
    return f"""SELECT '{name}' AS test, (m1 - m2) / sqrt(a + b) AS statistic, CAST(n1 + n2 AS BIGINT) AS n,
  't2' AS dist, (a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1)) AS df1, CAST(NULL AS DOUBLE) AS df2,
  m1 AS mean_1, m2 AS mean_0
FROM (SELECT *, v1 / n1 AS a, v2 / n2 AS b FROM (
  SELECT count_if(x) AS n1, avg(CASE WHEN x THEN v END) AS m1, var_samp(CASE WHEN x THEN v END) AS v1,
         count_if(NOT x) AS n2, avg(CASE WHEN NOT x THEN v END) AS m2, var_samp(CASE WHEN NOT x THEN v END) AS v2
  FROM ({src}) s WHERE x IS NOT NULL AND v IS NOT NULL) g) h"""


@register("mann_whitney_tests", " UNION ALL ".join(_mw_sql(n, s) for n, (_, s) in TWO.items()), group=G)
def q_mw(spark, sf_dir):
    t = tables(spark, sf_dir)
    return S.mann_whitney_tests({name: fn(t) for name, (fn, _) in TWO.items()})


# one-sided forms: the flag group's values are the greater ones
GREATER = {
    "converters_add_to_cart_greater": (
        lambda t: (t.leads.join(t.abt.select("customer_id", "total_add_to_cart"), "customer_id", "left"),
                   F.col("converted_30d"), F.coalesce(F.col("total_add_to_cart").cast("double"), F.lit(0.0)), "greater"),
        "SELECT l.converted_30d AS x, CAST(COALESCE(a.total_add_to_cart, 0) AS DOUBLE) AS v "
        "FROM leads l LEFT JOIN abt a ON l.customer_id = a.customer_id"),
    "repeaters_revenue_greater": (
        lambda t: (_repeat_profile(t), F.col("repeat_90d") == 1, "total_revenue", "greater"),
        "SELECT r.repeat_90d = 1 AS x, a.total_revenue AS v FROM abt a JOIN repeat_target r ON a.customer_id = r.customer_id"),
    "repeaters_acquisition_cost": (
        lambda t: (_repeat_profile(t), F.col("repeat_90d") == 1, "total_acquisition_cost", "two-sided"),
        "SELECT r.repeat_90d = 1 AS x, a.total_acquisition_cost AS v FROM abt a JOIN repeat_target r ON a.customer_id = r.customer_id"),
}


@register("mann_whitney_one_sided_tests", " UNION ALL ".join(
    _mw_sql(n, s, "greater" if n.endswith("_greater") else "two-sided") for n, (_, s) in GREATER.items()), group=G)
def q_mw_greater(spark, sf_dir):
    t = tables(spark, sf_dir)
    return S.mann_whitney_tests({name: fn(t) for name, (fn, _) in GREATER.items()})


@register("welch_tests", " UNION ALL ".join(_welch_sql(n, s) for n, (_, s) in TWO.items()), group=G)
def q_welch(spark, sf_dir):
    t = tables(spark, sf_dir)
    return S.union_all([S.welch_t(*fn(t), name) for name, (fn, _) in TWO.items()])


# --- correlations -------------------------------------------------------------
PB = {
    "purchased_x_add_to_cart": (lambda t: (t.abt, F.col("total_orders") > 0, F.coalesce(F.col("total_add_to_cart"), F.lit(0))),
                                "SELECT total_orders > 0 AS f, CAST(COALESCE(total_add_to_cart, 0) AS DOUBLE) AS v FROM abt"),
    "converted_x_discount": (lambda t: (t.leads, F.col("converted_30d"), F.coalesce(F.col("discount_offered_pct"), F.lit(0.0))),
                             "SELECT converted_30d AS f, COALESCE(discount_offered_pct, 0.0) AS v FROM leads"),
}
for _c in ("avg_pages_viewed", "avg_time_on_site", "total_add_to_cart", "total_checkout_started"):
    PB[f"intent_{_c}"] = ((lambda c: lambda t: (t.abt, F.col("total_orders") > 0,
                                               F.coalesce(F.col(c).cast("double"), F.lit(0.0))))(_c),
                          f"SELECT total_orders > 0 AS f, COALESCE(CAST({_c} AS DOUBLE), 0.0) AS v FROM abt")


def _pb_sql(name: str, src: str) -> str:
    return f"""SELECT '{name}' AS test, r AS statistic, CAST(n AS BIGINT) AS n, 't2' AS dist,
  CAST(n - 2 AS DOUBLE) AS df1, CAST(NULL AS DOUBLE) AS df2, r * sqrt((n - 2) / (1 - r * r)) AS t
FROM (SELECT corr(CAST(COALESCE(f, false) AS DOUBLE), v) AS r, count(*) AS n FROM ({src}) s WHERE v IS NOT NULL) g"""


@register("point_biserial_tests", " UNION ALL ".join(_pb_sql(n, s) for n, (_, s) in PB.items()), group=G)
def q_pb(spark, sf_dir):
    t = tables(spark, sf_dir)
    return S.union_all([S.point_biserial(*fn(t), name) for name, (fn, _) in PB.items()])


SPEAR = {
    "sessions_x_revenue": (lambda t: (t.abt, "total_sessions", "total_revenue"),
                           "SELECT CAST(total_sessions AS DOUBLE) AS x, total_revenue AS y FROM abt"),
    "discount_x_converted": (lambda t: (t.leads.withColumn("conv_i", F.col("converted_30d").cast("int")),
                                        "discount_offered_pct", "conv_i"),
                             "SELECT discount_offered_pct AS x, CAST(converted_30d AS DOUBLE) AS y FROM leads"),
}


def _spear_sql(name: str, src: str) -> str:
    return f"""SELECT '{name}' AS test, rho AS statistic, CAST(n AS BIGINT) AS n, 't2' AS dist,
  CAST(n - 2 AS DOUBLE) AS df1, CAST(NULL AS DOUBLE) AS df2, rho * sqrt((n - 2) / (1 - rho * rho)) AS t
FROM (SELECT corr(rx, ry) AS rho, count(*) AS n FROM (
  SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
         rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
  FROM ({src}) s WHERE x IS NOT NULL AND y IS NOT NULL) r) g"""


@register("spearman_tests", " UNION ALL ".join(_spear_sql(n, s) for n, (_, s) in SPEAR.items()), group=G)
def q_spear(spark, sf_dir):
    t = tables(spark, sf_dir)
    return S.spearman_tests({name: fn(t) for name, (fn, _) in SPEAR.items()})


# --- simple linear regressions (8 declared pairs) --------------------------------
SLR = {
    "leads_on_spend": (lambda t: (_lpc(t), F.col("spend_usd"), F.col("n_leads")),
                                "SELECT spend_usd AS x, n_leads AS y FROM lpc"),
    "revenue_on_lead_score": (lambda t: (t.abt, F.col("avg_lead_score"), F.col("total_revenue")),
                              "SELECT avg_lead_score AS x, total_revenue AS y FROM abt"),
    "conversion_on_time_on_site": (lambda t: (t.abt, F.col("avg_time_on_site"), F.col("LCR")),
                                   "SELECT avg_time_on_site AS x, \"LCR\" AS y FROM abt"),
    "add_to_cart_on_pages": (lambda t: (t.abt, F.col("avg_pages_viewed"), F.col("total_add_to_cart")),
                                    "SELECT avg_pages_viewed AS x, total_add_to_cart AS y FROM abt"),
    "revenue_on_discount": (lambda t: (t.transactions, F.col("discount_pct"), F.col("revenue_usd")),
                              "SELECT discount_pct AS x, revenue_usd AS y FROM transactions"),
    "value_on_acquisition_cost": (lambda t: (t.abt, F.col("total_acquisition_cost"), F.col("CLV_proxy")),
                                "SELECT total_acquisition_cost AS x, \"CLV_proxy\" AS y FROM abt"),
    "clicks_on_impressions": (lambda t: (t.campaigns, F.col("impressions"), F.col("clicks")),
                              "SELECT impressions AS x, clicks AS y FROM campaigns"),
    "repeat_on_engagement": (lambda t: (t.abt, F.col("avg_engagement_score"),
                                             (F.col("total_orders") >= 2).cast("int")),
                                  "SELECT avg_engagement_score AS x, CAST(total_orders >= 2 AS INTEGER) AS y FROM abt"),
}


def _lpc(t):
    from campanula.operators.campaign import leads_per_campaign
    return leads_per_campaign(t.campaigns, t.leads)


def _slr_sql(name: str, src: str) -> str:
    return f"""SELECT '{name}' AS model, CAST(n AS BIGINT) AS n,
  CASE WHEN n >= 5 THEN slope END AS slope, CASE WHEN n >= 5 THEN intercept END AS intercept,
  CASE WHEN n >= 5 THEN r END AS r, CASE WHEN n >= 5 THEN r * r END AS "R2",
  CASE WHEN n >= 5 THEN r * sqrt((n - 2) / (1 - r * r)) END AS t, CAST(n - 2 AS DOUBLE) AS df1
FROM (SELECT count(*) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, corr(x, y) AS r
      FROM (SELECT CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM ({src}) s0) s
      WHERE x IS NOT NULL AND y IS NOT NULL AND isfinite(x) AND isfinite(y)) g"""


@register("slr_results", "WITH lpc AS (SELECT c.campaign_id, c.spend_usd, COALESCE(n.n_leads, 0) AS n_leads "
          "FROM campaigns c LEFT JOIN (SELECT campaign_id, count(*) AS n_leads FROM leads "
          "WHERE campaign_id IS NOT NULL GROUP BY campaign_id) n ON c.campaign_id = n.campaign_id) "
          + " UNION ALL ".join(_slr_sql(n, s) for n, (_, s) in SLR.items()), group=G)
def q_slr(spark, sf_dir):
    t = tables(spark, sf_dir)
    return S.union_all([S.slr(*fn(t), name) for name, (fn, _) in SLR.items()])


# --- p-values ------------------------------------------------------------------
_P_SOURCES = {"chi2_tests": "statistic", "chi2_table_tests": "statistic", "kruskal_tests": "statistic", "anova_tests": "statistic",
              "mann_whitney_tests": "z", "mann_whitney_one_sided_tests": "z", "welch_tests": "statistic",
              "point_biserial_tests": "t", "spearman_tests": "t"}  # the tail is taken on z or t


def p_sql(rows: str) -> str:
    """``rows`` (test, statistic, p_stat, n, dist, df1, df2) with p-values: tails by plain
    sums on an even grid of ln(distance from the statistic)."""
    return f"""SELECT test, statistic, p_stat, n, dist, df1, df2, p_value,
  CASE WHEN p_value < 0.001 THEN '***' WHEN p_value < 0.01 THEN '**' WHEN p_value < 0.05 THEN '*' ELSE 'ns' END AS significance
FROM (SELECT test, statistic, p_stat, n, dist, df1, df2,
        CASE WHEN dist <> 'norm1' THEN share WHEN p_stat > 0 THEN share / 2 ELSE 1 - share / 2 END AS p_value
  FROM (SELECT r, any_value(test) AS test, any_value(statistic) AS statistic, any_value(p_stat) AS p_stat, any_value(n) AS n, any_value(dist) AS dist,
          any_value(df1) AS df1, any_value(df2) AS df2,
          CASE WHEN any_value(x) <= 0 THEN 1.0 ELSE sum(s * exp(least(a * s - fall_right, 700.0)))
            / (sum(s * exp(least(a * s - fall_right, 700.0))) + sum(s * exp(least(-a * s - fall_left, 700.0)))) END AS share
    FROM (SELECT *, CASE WHEN b IS NULL THEN x / 2 * (exp(s) - 1) ELSE (a + b) * ln((b + a * x * exp(s)) / (b + a * x)) END AS fall_right,
            CASE WHEN b IS NULL THEN x / 2 * (exp(-s) - 1) ELSE (a + b) * ln((b + a * x * exp(-s)) / (b + a * x)) END AS fall_left
      FROM (SELECT *, CASE WHEN dist IN ('norm1', 'norm2', 't2') THEN p_stat * p_stat ELSE p_stat END AS x,
              CASE WHEN dist IN ('norm1', 'norm2', 't2') THEN 0.5 ELSE df1 / 2 END AS a,
              CASE dist WHEN 't2' THEN df1 / 2 WHEN 'f' THEN df2 / 2 END AS b
            FROM (SELECT *, row_number() OVER () AS r FROM ({rows}) u) v) w,
           (SELECT exp(k / 50.0) AS s FROM range(-2250, 300) g(k)) grid) d
    GROUP BY r) e) f"""


def _all_tests_sql() -> str:
    parts = [f"SELECT test, statistic, {p} AS p_stat, n, dist, df1, df2 FROM ({oracle_body(name)}) {name}_"
             for name, p in _P_SOURCES.items()]
    parts.append(f"SELECT 'slr: ' || model, slope, t, n, 't2', df1, NULL FROM ({oracle_body('slr_results')}) slr_")
    return p_sql(" UNION ALL ".join(parts))


@register("hypothesis_tests_with_p", _all_tests_sql(), group=G)
def q_all_p(spark, sf_dir):
    from campanula.plans.registry import queries
    qs = queries()
    parts = []
    for name, p in _P_SOURCES.items():
        parts.append(qs[name](spark, sf_dir).select("test", "statistic", F.col(p).alias("p_stat"), "n", "dist", "df1", "df2"))
    slr = qs["slr_results"](spark, sf_dir).select(
        F.concat(F.lit("slr: "), F.col("model")).alias("test"), F.col("slope").alias("statistic"),
        F.col("t").alias("p_stat"), "n", F.lit("t2").alias("dist"), "df1", F.lit(None).cast("double").alias("df2"))
    return S.with_p_values(S.union_all(parts + [slr]), stat="p_stat")
