"""Bind the driver's TPC-H-style parquet tables to the five marketing tables.

The binding produces *bronze* tables: every business column is a dirty
string, exactly like the raw CSV exports the library is meant to clean
(currency with ``$``/``USD``/thousands separators, percentages as ``15%``
or ``15 percent``, mixed boolean encodings, five date formats, label case
and spacing noise).  The dirt is a deterministic function of the source
keys, so the SQL oracle can rebuild identical strings.  Each bronze table
is a single projection over a scan (plus one pre-aggregated join for leads
and two dimension joins for transactions), so it scales with the input.

Logical table      source
customers          customer + nation + region
campaigns          supplier + nation + region
leads              orders + per-order (min supplier, min ship date) of lineitem
website_sessions   events
transactions       lineitem + orders + part
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the vocabularies the dirty generator draws from ----------
CHANNELS = ("email", "paid search", "search", "affiliate", "paid social", "display", "influencer")
CHANNEL_SPELLINGS = (
    ("E-mail", " Email"),
    ("Paid Search", "paid search "),
    ("Search", "SEARCH"),
    ("Affiliate", "affiliate"),
    ("Paid-Social", "paid social"),
    ("Display", " display"),
    ("Influencers", "influencer"),
)
OBJECTIVES = ("Lead Gen", "Awareness", "Retention", "Conversion")
CREATIVES = ("Video", "Carousel", "Promo", "Static", "Testimonial", "UGC")
LANDING_PAGES = ("/landing-a", "/landing-b", "/bundle-offer", "/new-arrivals", "/quiz", "/promo-summer")
GENDERS = ("M", " female", "Male ", "F", "unknown")  # position 5 of 6 -> null
DEVICES = ("Mobile", "desktop ", "Tablet", "phone", " Tab")
OBSERVED_REGIONS = ("SW", " South West", "ne", "North East ", "WEST", "east", "south-west", "S/South", "N Central", "north cntrl")
PAYMENTS = ("Card", "paypal ", "CASH", "Gift Card")
LEAD_SOURCES = {
    "1-URGENT": "Google", "2-HIGH": " meta", "3-MEDIUM": "CRM",
    "4-NOT SPECIFIED": "Organic ", "5-LOW": "REFERRAL",
}
TRUE_TOKENS = ("Yes", "1", "true", " TRUE ", "1.0")
FALSE_TOKENS = ("no", "0", "False", "N", None)
DATE_PATTERNS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM-dd-yyyy", "dd/MM/yyyy", "MMM dd, yyyy")
# -----------------------------------------------------------------------------

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one source table, split as the reader splits it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, values) -> Column:
    """values[index] as a CASE expression (index is a non-negative int column)."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def money_text(cents: Column, variant: Column) -> Column:
    """Currency string from integer cents: ``$1,234.56``, ``USD 1,234.56``,
    ``1,234.56`` or ``1234.56`` (variant 0..3); the sign follows the symbol."""
    a = F.abs(cents)
    dollars = ((a - a % 100) / 100).cast("bigint")
    frac = F.lpad((a % 100).cast("string"), 2, "0")
    sign = F.when(cents < 0, F.lit("-")).otherwise(F.lit(""))
    grouped = F.concat(F.format_number(dollars, 0), F.lit("."), frac)
    plain = F.concat(dollars.cast("string"), F.lit("."), frac)
    return (F.when(variant == 0, F.concat(F.lit("$"), sign, grouped))
            .when(variant == 1, F.concat(F.lit("USD "), sign, grouped))
            .when(variant == 2, F.concat(sign, grouped))
            .otherwise(F.concat(sign, plain)))


def percent_text(points: Column, variant: Column) -> Column:
    p = points.cast("string")
    return (F.when(variant == 0, p)
            .when(variant == 1, F.concat(p, F.lit("%")))
            .when(variant == 2, F.concat(p, F.lit(" percent")))
            .otherwise(F.concat(p, F.lit(" PERCENT"))))


def bool_text(value: Column, variant: Column) -> Column:
    return F.when(value, _pick(variant, TRUE_TOKENS)).otherwise(_pick(variant, FALSE_TOKENS))


def date_text(ts: Column, variant: Column) -> Column:
    expr = None
    for i, pat in enumerate(DATE_PATTERNS):
        v = F.date_format(ts, pat)
        expr = F.when(variant == i, v) if expr is None else expr.when(variant == i, v)
    return expr


def channel_text(index: Column, variant: Column) -> Column:
    expr = None
    for i, pair in enumerate(CHANNEL_SPELLINGS):
        v = F.when(variant == 0, F.lit(pair[0])).otherwise(F.lit(pair[1]))
        expr = F.when(index == i, v) if expr is None else expr.when(index == i, v)
    return expr


def _cents(x: Column) -> Column:
    return F.round(x * 100).cast("bigint")


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    k = F.col("c_custkey")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    df = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey, "left")
    age = (F.when(k % 11 == 0, F.lit("-4")).when(k % 13 == 0, F.lit("150"))
           .when(k % 17 == 0, F.lit("n/a")).otherwise((F.lit(18) + (k * 7) % 63).cast("string")))
    region = (F.when(k % 3 == 0, F.col("r_name")).when(k % 3 == 1, F.lower("r_name"))
              .otherwise(F.concat(F.lit("  "), F.col("r_name"), F.lit(" "))))
    bal = F.col("c_acctbal")
    tier = (F.when(bal < 0, "Bronze").when(bal < 3000, "silver ").when(bal < 7000, "GOLD")
            .otherwise("Platinum"))
    signup = F.date_add(F.lit("1995-01-01").cast("date"), (k % 700).cast("int"))
    return df.select(
        k.cast("string").alias("customer_id"),
        _pick(k % 6, GENDERS).alias("gender"),
        age.alias("age"),
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("city"),
        region.alias("region"),
        date_text(signup, k % 5).alias("signup_date"),
        _pick(k % 5, DEVICES).alias("preferred_device"),
        tier.alias("loyalty_tier"),
        bool_text(k % 3 != 0, k % 5).alias("email_opt_in"),
        F.col("c_mktsegment").alias("income_band"),
        k.alias("_src_row"),
    )


def bronze_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    k = F.col("s_suppkey")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    df = s.join(F.broadcast(geo), s.s_nationkey == geo.n_nationkey, "left")
    start = F.date_add(F.lit("1995-01-01").cast("date"), ((k * 37) % 2000).cast("int"))
    end = F.date_add(start, ((k % 90) - 5).cast("int"))
    imp = F.lit(1000) + (k * 7919) % 100000
    clicks = F.when(k % 25 == 0, imp + 5).otherwise(((imp * ((k % 9) + 1)) - (imp * ((k % 9) + 1)) % 100) / 100)
    return df.select(
        k.cast("string").alias("campaign_id"),
        F.col("s_name").alias("campaign_name"),
        channel_text(k % 7, (((k - k % 7) / 7) % 2).cast("bigint")).alias("channel"),
        _pick(k % 4, OBJECTIVES).alias("objective"),
        date_text(start, k % 5).alias("start_date"),
        date_text(end, (k + 1) % 5).alias("end_date"),
        money_text((F.lit(4000) + (k % 7) * 500) * 100, k % 4).alias("budget_usd"),
        money_text(_cents(F.col("s_acctbal")), (k + 1) % 4).alias("spend_usd"),
        F.when(k % 10 == 0, F.lit("All")).otherwise(F.col("r_name")).alias("target_region"),
        _pick(k % 6, CREATIVES).alias("creative_type"),
        F.when(k % 3 == 0, F.format_number(imp, 0)).otherwise(imp.cast("string")).alias("impressions"),
        clicks.cast("bigint").cast("string").alias("clicks"),
        k.alias("_src_row"),
    )


def bronze_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    # Pre-aggregate the fact side to one row per order before joining.
    first = li.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("min_supp"),
                                         F.min("l_shipdate").alias("min_ship"))
    df = o.join(first, o.o_orderkey == first.l_orderkey, "left")
    k = F.col("o_orderkey")
    status_f = F.col("o_orderstatus") == "F"
    prio = None
    for key, val in LEAD_SOURCES.items():
        cond = F.col("o_orderpriority") == key
        prio = F.when(cond, F.lit(val)) if prio is None else prio.when(cond, F.lit(val))
    score = (k * 37) % 60 + F.when(status_f, F.lit(30)).otherwise(F.lit(0))
    return df.select(
        k.cast("string").alias("lead_id"),
        F.when(k % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("min_supp").cast("string").alias("campaign_id"),
        date_text(F.col("o_orderdate"), k % 5).alias("lead_date"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("string"))
         .otherwise(date_text(F.col("min_ship"), (k + 2) % 5)).alias("conversion_date"),
        prio.alias("lead_source"),
        _pick(k % 6, LANDING_PAGES).alias("landing_page"),
        percent_text((((k - k % 7) / 7) % 6).cast("bigint") * 5,
                     (((k - k % 6) / 6) % 4).cast("bigint")).alias("discount_offered_pct"),
        F.when(k % 37 == 0, F.lit("high")).otherwise(score.cast("string")).alias("lead_score"),
        F.when(k % 23 != 0, _pick(F.when(k % 7 == 0, k % 3).otherwise((k * 7) % 10), OBSERVED_REGIONS)).alias("observed_region"),
        bool_text(status_f, k % 5).alias("converted_30d"),
        money_text(F.lit(500) + (k * 7) % 4000, F.when(k % 3 == 2, F.lit(3)).otherwise(k % 3)).alias("acquisition_cost_usd"),
    )


def bronze_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = F.col("event_id")
    u = F.col("user_id")
    et = F.col("event_type")
    tos = (F.when(k % 53 == 0, F.lit("90000")).when(k % 29 == 0, F.lit("-1"))
           .otherwise(_cents(F.col("value")).cast("string")))
    return e.select(
        k.cast("string").alias("session_id"),
        F.when(k % 40 == 0, F.lit(None).cast("string")).otherwise(u.cast("string")).alias("customer_id"),
        ((k * 7 + u) % 100).cast("string").alias("campaign_id"),
        date_text(F.col("ts"), k % 5).alias("session_date"),
        _pick(k % 5, DEVICES).alias("device"),
        channel_text((k * 3 + u) % 7, k % 2).alias("channel_group"),
        F.when(k % 31 != 0, _pick((k + u) % 10, OBSERVED_REGIONS)).alias("geo_region"),
        F.get_json_object("props", "$.k").alias("pages_viewed"),
        tos.alias("time_on_site_sec"),
        bool_text(et == "error", k % 5).alias("bounce"),
        bool_text(et == "click", (k + 1) % 5).alias("add_to_cart"),
        bool_text(et == "purchase", (k + 2) % 5).alias("checkout_started"),
    )


def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    df = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey, "left")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    price = _cents(F.col("l_extendedprice"))
    disc = F.round(F.col("l_discount") * 100).cast("bigint")
    gross = price * (F.lit(100) - disc)
    rev = ((gross - gross % 100) / 100).cast("bigint")
    ptype = F.col("p_type")
    category = (F.when(F.col("l_partkey") % 3 == 0, ptype).when(F.col("l_partkey") % 3 == 1, F.lower(ptype))
                .otherwise(F.concat(ptype, F.lit(" "))))
    channel = F.concat(channel_text(F.col("l_suppkey") % 7, ok % 2),
                       F.when(ln % 2 == 0, F.lit("  ")).otherwise(F.lit("")))
    return df.select(
        F.concat(ok.cast("string"), F.lit("-"), ln.cast("string")).alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        date_text(F.col("o_orderdate"), (ok + ln) % 5).alias("order_date"),
        category.alias("product_category"),
        F.col("l_quantity").cast("bigint").cast("string").alias("units"),
        money_text(rev, (ok + ln) % 4).alias("revenue_usd"),
        percent_text(disc, ok % 4).alias("discount_pct"),
        _pick(ok % 4, PAYMENTS).alias("payment_type"),
        bool_text(F.col("l_returnflag") == "R", (ok + ln) % 5).alias("returned_flag"),
        channel.alias("marketing_channel_last_touch"),
    )


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": bronze_customers(spark, sf_dir),
        "campaigns": bronze_campaigns(spark, sf_dir),
        "leads": bronze_leads(spark, sf_dir),
        "sessions": bronze_sessions(spark, sf_dir),
        "transactions": bronze_transactions(spark, sf_dir),
    }
