"""DuckDB-dialect SQL for the oracle: bronze generation, silver cleaning.

The oracle is an independent re-statement of every query in plain SQL over
the driver's pre-registered views.  Bronze strings are rebuilt with DuckDB
string functions (``format``, ``strftime``) and cleaned with DuckDB regex /
``try_strptime``, so a bug on either side shows up as a mismatch.

Queries are assembled from named CTEs; ``sql_with`` pulls in dependencies
transitively in a stable order.
"""

from __future__ import annotations

import re

from campanula.functions import clean as C
from campanula.sources import testdata as TD

# Spark pattern -> strftime pattern, for the fixed date formats.
_SPARK_TO_STRF = {
    "yyyy-MM-dd": "%Y-%m-%d", "yyyy/MM/dd": "%Y/%m/%d", "MM-dd-yyyy": "%m-%d-%Y",
    "MM/dd/yyyy": "%m/%d/%Y", "dd/MM/yyyy": "%d/%m/%Y", "dd-MM-yyyy": "%d-%m-%Y",
    "MMM dd, yyyy": "%b %d, %Y", "MMM d, yyyy": "%b %-d, %Y",
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
}
NUMERIC_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# synonyms, stated apart from the library's so that a wrong entry there shows
_SHORT = {"n": "north", "s": "south"}
_REGIONS = {f"{a}{b[0]}": f"{long} {b}" for a, long in _SHORT.items() for b in ("west", "east")} | {
    "south-west": "south west", "s/south": "south", "s/s": "south", **{x: "north central" for x in ("n central", "north cntrl", "north c.")}}
_TARGETS = _REGIONS | {"all": "nationwide"}
_DEVICES = {"phone": "mobile", "tab": "tablet"}
_GENDERS = {"m": "male", "f": "female"}
_CHANNELS = {"e-mail": "email", "paid-social": "paid social", "influencers": "influencer"}
_CATEGORIES = {"baby care": "baby", "personal-care": "personal care", "beverage": "beverages"}


def q(s: str | None) -> str:
    if s is None:
        return "NULL"
    return "'" + s.replace("'", "''") + "'"


def pick(idx: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values))
    return f"(CASE {idx} {whens} END)"


def money(cents: str, variant: str) -> str:
    a = f"abs({cents})"
    dollars = f"({a} // 100)"
    frac = f"lpad(CAST({a} % 100 AS VARCHAR), 2, '0')"
    sign = f"(CASE WHEN {cents} < 0 THEN '-' ELSE '' END)"
    grouped = f"(format('{{:,}}', {dollars}) || '.' || {frac})"
    plain = f"(CAST({dollars} AS VARCHAR) || '.' || {frac})"
    return (f"(CASE WHEN {variant} = 0 THEN '$' || {sign} || {grouped} "
            f"WHEN {variant} = 1 THEN 'USD ' || {sign} || {grouped} "
            f"WHEN {variant} = 2 THEN {sign} || {grouped} ELSE {sign} || {plain} END)")


def percent(points: str, variant: str) -> str:
    p = f"CAST({points} AS VARCHAR)"
    return (f"(CASE WHEN {variant} = 0 THEN {p} WHEN {variant} = 1 THEN {p} || '%' "
            f"WHEN {variant} = 2 THEN {p} || ' percent' ELSE {p} || ' PERCENT' END)")


def booltext(value: str, variant: str) -> str:
    return f"(CASE WHEN {value} THEN {pick(variant, TD.TRUE_TOKENS)} ELSE {pick(variant, TD.FALSE_TOKENS)} END)"


def datetext(ts: str, variant: str) -> str:
    whens = " ".join(f"WHEN {i} THEN strftime({ts}, {q(_SPARK_TO_STRF[p])})"
                     for i, p in enumerate(TD.DATE_PATTERNS))
    return f"(CASE {variant} {whens} END)"


def channeltext(index: str, variant: str) -> str:
    whens = " ".join(f"WHEN {i} THEN (CASE WHEN {variant} = 0 THEN {q(a)} ELSE {q(b)} END)"
                     for i, (a, b) in enumerate(TD.CHANNEL_SPELLINGS))
    return f"(CASE {index} {whens} END)"


# --- cleaning, SQL side -----------------------------------------------------
def to_number(s: str, strip=()) -> str:
    x = f"CAST({s} AS VARCHAR)"
    for t in strip:
        x = f"replace({x}, {q(t)}, '')"
    x = f"trim({x})"
    return f"(CASE WHEN regexp_matches({x}, {q(NUMERIC_RE)}) THEN TRY_CAST({x} AS DOUBLE) END)"


def currency(s: str) -> str:
    return to_number(s, ('$', ',', 'USD'))


def pct(s: str) -> str:
    return to_number(f"lower({s})", ('%', 'percent'))


def boolean(s: str, truthy=('yes', 'true', '1', '1.0')) -> str:
    return f"COALESCE(lower(trim({s})) IN ({', '.join(q(t) for t in truthy)}), false)"


def date(s: str) -> str:
    parts = ", ".join(f"CAST(try_strptime(trim({s}), {q(_SPARK_TO_STRF[f])}) AS DATE)" for f in C.DATE_FORMATS)
    return f"COALESCE({parts})"


def norm(s: str) -> str:
    return f"lower(trim({s}))"


def mapped(s: str, mapping: dict) -> str:
    x = norm(s)
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {x} {whens} ELSE {x} END)"


def nullif_pred(x: str, pred: str) -> str:
    return f"(CASE WHEN COALESCE({pred}, false) THEN NULL ELSE {x} END)"


def safe_div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def safe_div0(a: str, b: str) -> str:
    return f"(CASE WHEN COALESCE(CAST({b} AS DOUBLE) > 0, false) THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) ELSE 0.0 END)"


# --- CTE registry -------------------------------------------------------------
CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


_prio = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in TD.LEAD_SOURCES.items())

cte("b_customers", f"""
SELECT CAST(k AS VARCHAR) AS customer_id,
  {pick('k % 6', TD.GENDERS)} AS gender,
  CASE WHEN k % 11 = 0 THEN '-4' WHEN k % 13 = 0 THEN '150' WHEN k % 17 = 0 THEN 'n/a'
       ELSE CAST(18 + (k * 7) % 63 AS VARCHAR) END AS age,
  CASE WHEN k % 19 = 0 THEN NULL ELSE n_name END AS city,
  CASE WHEN k % 3 = 0 THEN r_name WHEN k % 3 = 1 THEN lower(r_name) ELSE '  ' || r_name || ' ' END AS region,
  {datetext("(DATE '1995-01-01' + CAST(k % 700 AS INTEGER))", 'k % 5')} AS signup_date,
  {pick('k % 5', TD.DEVICES)} AS preferred_device,
  CASE WHEN c_acctbal < 0 THEN 'Bronze' WHEN c_acctbal < 3000 THEN 'silver '
       WHEN c_acctbal < 7000 THEN 'GOLD' ELSE 'Platinum' END AS loyalty_tier,
  {booltext('k % 3 <> 0', 'k % 5')} AS email_opt_in,
  c_mktsegment AS income_band,
  k AS _src_row
FROM (SELECT c.*, c.c_custkey AS k, g.n_name, g.r_name FROM customer c
      LEFT JOIN (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) g
      ON c.c_nationkey = g.n_nationkey) t""")

cte("b_campaigns", f"""
SELECT CAST(k AS VARCHAR) AS campaign_id, s_name AS campaign_name,
  {channeltext('k % 7', '(k // 7) % 2')} AS channel,
  {pick('k % 4', TD.OBJECTIVES)} AS objective,
  {datetext('st', 'k % 5')} AS start_date,
  {datetext('(st + CAST((k % 90) - 5 AS INTEGER))', '(k + 1) % 5')} AS end_date,
  {money('((4000 + (k % 7) * 500) * 100)', 'k % 4')} AS budget_usd,
  {money('CAST(round(s_acctbal * 100) AS BIGINT)', '(k + 1) % 4')} AS spend_usd,
  CASE WHEN k % 10 = 0 THEN 'All' ELSE r_name END AS target_region,
  {pick('k % 6', TD.CREATIVES)} AS creative_type,
  CASE WHEN k % 3 = 0 THEN format('{{:,}}', imp) ELSE CAST(imp AS VARCHAR) END AS impressions,
  CAST(CASE WHEN k % 25 = 0 THEN imp + 5 ELSE (imp * ((k % 9) + 1)) // 100 END AS VARCHAR) AS clicks,
  k AS _src_row
FROM (SELECT s.*, s.s_suppkey AS k, g.r_name,
             DATE '1995-01-01' + CAST((s.s_suppkey * 37) % 2000 AS INTEGER) AS st,
             1000 + (s.s_suppkey * 7919) % 100000 AS imp
      FROM supplier s
      LEFT JOIN (SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) g
      ON s.s_nationkey = g.n_nationkey) t""")

cte("b_leads", f"""
SELECT CAST(k AS VARCHAR) AS lead_id,
  CASE WHEN k % 50 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
  CAST(min_supp AS VARCHAR) AS campaign_id,
  {datetext('o_orderdate', 'k % 5')} AS lead_date,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {datetext('min_ship', '(k + 2) % 5')} END AS conversion_date,
  (CASE o_orderpriority {_prio} END) AS lead_source,
  {pick('k % 6', TD.LANDING_PAGES)} AS landing_page,
  {percent('((k // 7) % 6) * 5', '(k // 6) % 4')} AS discount_offered_pct,
  CASE WHEN k % 37 = 0 THEN 'high'
       ELSE CAST((k * 37) % 60 + CASE WHEN o_orderstatus = 'F' THEN 30 ELSE 0 END AS VARCHAR) END AS lead_score,
  CASE WHEN k % 23 <> 0 THEN {pick('(CASE WHEN k % 7 = 0 THEN k % 3 ELSE (k * 7) % 10 END)', TD.OBSERVED_REGIONS)} END AS observed_region,
  {booltext("o_orderstatus = 'F'", 'k % 5')} AS converted_30d,
  {money('(500 + (k * 7) % 4000)', 'CASE WHEN k % 3 = 2 THEN 3 ELSE k % 3 END')} AS acquisition_cost_usd
FROM (SELECT o.*, o.o_orderkey AS k, f.min_supp, f.min_ship FROM orders o
      LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS min_supp, min(l_shipdate) AS min_ship
                 FROM lineitem GROUP BY l_orderkey) f ON o.o_orderkey = f.l_orderkey) t""")

cte("b_sessions", f"""
SELECT CAST(k AS VARCHAR) AS session_id,
  CASE WHEN k % 40 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS customer_id,
  CAST((k * 7 + user_id) % 100 AS VARCHAR) AS campaign_id,
  {datetext('ts', 'k % 5')} AS session_date,
  {pick('k % 5', TD.DEVICES)} AS device,
  {channeltext('(k * 3 + user_id) % 7', 'k % 2')} AS channel_group,
  CASE WHEN k % 31 <> 0 THEN {pick('(k + user_id) % 10', TD.OBSERVED_REGIONS)} END AS geo_region,
  json_extract_string(props, '$.k') AS pages_viewed,
  CASE WHEN k % 53 = 0 THEN '90000' WHEN k % 29 = 0 THEN '-1'
       ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS time_on_site_sec,
  {booltext("event_type = 'error'", 'k % 5')} AS bounce,
  {booltext("event_type = 'click'", '(k + 1) % 5')} AS add_to_cart,
  {booltext("event_type = 'purchase'", '(k + 2) % 5')} AS checkout_started
FROM (SELECT e.*, e.event_id AS k FROM events e) t""")

cte("b_transactions", f"""
SELECT CAST(ok AS VARCHAR) || '-' || CAST(ln AS VARCHAR) AS order_id,
  CAST(o_custkey AS VARCHAR) AS customer_id,
  {datetext('o_orderdate', '(ok + ln) % 5')} AS order_date,
  CASE WHEN l_partkey % 3 = 0 THEN p_type WHEN l_partkey % 3 = 1 THEN lower(p_type) ELSE p_type || ' ' END AS product_category,
  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS units,
  {money('((price * (100 - disc)) // 100)', '(ok + ln) % 4')} AS revenue_usd,
  {percent('disc', 'ok % 4')} AS discount_pct,
  {pick('ok % 4', TD.PAYMENTS)} AS payment_type,
  {booltext("l_returnflag = 'R'", '(ok + ln) % 5')} AS returned_flag,
  {channeltext('l_suppkey % 7', 'ok % 2')} || CASE WHEN ln % 2 = 0 THEN '  ' ELSE '' END AS marketing_channel_last_touch
FROM (SELECT l.*, l.l_orderkey AS ok, l.l_linenumber AS ln, o.o_custkey, o.o_orderdate, p.p_type,
             CAST(round(l.l_extendedprice * 100) AS BIGINT) AS price,
             CAST(round(l.l_discount * 100) AS BIGINT) AS disc
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      LEFT JOIN part p ON l.l_partkey = p.p_partkey) t""")

cte("customers", f"""
SELECT customer_id,
  {mapped('gender', _GENDERS)} AS gender,
  {nullif_pred(to_number('age'), f"{to_number('age')} < 0 OR {to_number('age')} > 120")} AS age,
  city,
  {mapped('region', _REGIONS)} AS region,
  {date('signup_date')} AS signup_date,
  {mapped('preferred_device', _DEVICES)} AS preferred_device,
  {boolean('email_opt_in')} AS email_opt_in,
  {norm('loyalty_tier')} AS loyalty_tier,
  income_band
FROM b_customers
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _src_row) = 1""")

cte("campaigns", f"""
SELECT campaign_id, campaign_name, channel, objective, start_date, end_date,
  date_diff('day', start_date, end_date) AS duration_days,
  budget_usd, {nullif_pred('spend_usd', 'spend_usd < 0')} AS spend_usd,
  target_region, creative_type, impressions, clicks
FROM (SELECT campaign_id, campaign_name,
        {mapped('channel', _CHANNELS)} AS channel,
        trim(objective) AS objective,
        {date('start_date')} AS start_date, {date('end_date')} AS end_date,
        {currency('budget_usd')} AS budget_usd, {currency('spend_usd')} AS spend_usd,
        {mapped('target_region', _TARGETS)} AS target_region,
        trim(creative_type) AS creative_type,
        CAST({to_number('impressions', (',',))} AS BIGINT) AS impressions,
        CAST({to_number('clicks', (',',))} AS BIGINT) AS clicks
      FROM b_campaigns
      QUALIFY row_number() OVER (PARTITION BY campaign_id ORDER BY _src_row) = 1) t""")

cte("leads", f"""
SELECT lead_id, customer_id, campaign_id, lead_date,
  CASE WHEN conversion_date < lead_date THEN NULL ELSE conversion_date END AS conversion_date,
  lead_source, landing_page, discount_offered_pct, lead_score, observed_region, converted_30d, acquisition_cost_usd
FROM (SELECT lead_id, customer_id, campaign_id,
        {date('lead_date')} AS lead_date, {date('conversion_date')} AS conversion_date,
        {norm('lead_source')} AS lead_source, landing_page,
        {pct('discount_offered_pct')} AS discount_offered_pct,
        {to_number('lead_score')} AS lead_score,
        {mapped('observed_region', _REGIONS)} AS observed_region,
        {boolean('converted_30d')} AS converted_30d,
        {currency('acquisition_cost_usd')} AS acquisition_cost_usd
      FROM b_leads) t""")

cte("sessions", f"""
SELECT session_id, customer_id, campaign_id, session_date, device, channel_group, geo_region,
  CASE WHEN pages_viewed <= 0 THEN NULL ELSE pages_viewed END AS pages_viewed,
  CASE WHEN time_on_site_sec <= 0 OR time_on_site_sec > 86400 THEN NULL ELSE time_on_site_sec END AS time_on_site_sec,
  bounce, add_to_cart, checkout_started
FROM (SELECT session_id, customer_id, campaign_id, {date('session_date')} AS session_date,
        {mapped('device', _DEVICES)} AS device, {mapped('channel_group', _CHANNELS)} AS channel_group,
        {mapped('geo_region', _REGIONS)} AS geo_region,
        {to_number('pages_viewed')} AS pages_viewed, {to_number('time_on_site_sec')} AS time_on_site_sec,
        {boolean('bounce')} AS bounce, {boolean('add_to_cart')} AS add_to_cart,
        {boolean('checkout_started')} AS checkout_started
      FROM b_sessions) t""")

cte("transactions", f"""
SELECT order_id, customer_id, {date('order_date')} AS order_date,
  {mapped('product_category', _CATEGORIES)} AS product_category,
  {to_number('units')} AS units,
  {currency('revenue_usd')} AS revenue_usd,
  {pct('discount_pct')} AS discount_pct,
  {norm('payment_type')} AS payment_type,
  {boolean('returned_flag')} AS returned_flag,
  {mapped('marketing_channel_last_touch', _CHANNELS)} AS marketing_channel_last_touch
FROM b_transactions""")


_IDENT = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(sql: str, known: set[str]) -> list[str]:
    found = []
    for m in _IDENT.finditer(sql):
        name = m.group(1)
        if name in known and name not in found:
            found.append(name)
    return found


def sql_with(body: str) -> str:
    """Prefix ``body`` with every registered CTE it (transitively) uses."""
    known = set(CTES)
    order: list[str] = []

    def visit(name: str, stack: tuple = ()):
        if name in order or name in stack:
            return
        for d in _deps(CTES[name], known - {name}):
            visit(d, stack + (name,))
        order.append(name)

    for d in _deps(body, known):
        visit(d)
    if not order:
        return body
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in order)
    stripped = body.lstrip()
    if stripped[:4].upper() == "WITH":
        # merge the body's own CTE list into ours
        return "WITH " + head + ",\n" + stripped[4:].lstrip()
    return "WITH " + head + "\n" + body
