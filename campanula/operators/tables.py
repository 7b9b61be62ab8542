"""Bronze (all-string) -> silver (typed) per logical table.

Each function is one projection (plus a keep-first dedupe for the two
dimension tables), so cleaning fuses into the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campanula.functions import clean as C


def dedupe_first(df: DataFrame, key: str, order: str | list[str]) -> DataFrame:
    """AUD-02: keep the first row per key in source order.

    ``min_by`` over a struct of the row, keyed by the source order, is a
    partial aggregate: duplicates are combined map-side, so a key repeated
    on a third of all rows is never sorted in one task (as a ``row_number``
    window partitioned by the key would be).  Null keys form one group and
    keep their first row, like pandas ``drop_duplicates``.
    """
    order_cols = [order] if isinstance(order, str) else list(order)
    cols = [c for c in df.columns if c != key]
    sk = F.struct(*[F.col(c) for c in order_cols])
    kept = df.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), sk).alias("_row"))
    return kept.select(key, *[F.col(f"_row.{c}").alias(c) for c in cols])


def clean_customers(bronze: DataFrame) -> DataFrame:
    df = dedupe_first(bronze, "customer_id", "_src_row")
    age = C.to_number("age")
    return df.select(
        "customer_id",
        C.map_label("gender", C.GENDER_MAP).alias("gender"),
        C.null_if(age, (age < 0) | (age > 120)).alias("age"),
        "city",
        C.map_label("region", C.REGION_MAP).alias("region"),
        C.parse_date("signup_date").alias("signup_date"),
        C.map_label("preferred_device", C.DEVICE_MAP).alias("preferred_device"),
        C.parse_bool("email_opt_in").alias("email_opt_in"),
        C.norm_label("loyalty_tier").alias("loyalty_tier"),
        "income_band",
    )


def clean_campaigns(bronze: DataFrame) -> DataFrame:
    df = dedupe_first(bronze, "campaign_id", "_src_row")
    start = C.parse_date("start_date")
    end = C.parse_date("end_date")
    spend = C.clean_currency("spend_usd")
    return df.select(
        "campaign_id", "campaign_name",
        C.map_label("channel", C.CHANNEL_MAP).alias("channel"),
        F.trim("objective").alias("objective"),
        start.alias("start_date"), end.alias("end_date"),
        C.days_between(end, start).alias("duration_days"),
        C.clean_currency("budget_usd").alias("budget_usd"),
        C.null_if(spend, spend < 0).alias("spend_usd"),
        C.map_label("target_region", C.TARGET_REGION_MAP).alias("target_region"),
        F.trim("creative_type").alias("creative_type"),
        C.to_number("impressions", (",",)).cast("bigint").alias("impressions"),
        C.to_number("clicks", (",",)).cast("bigint").alias("clicks"),
    )


def clean_leads(bronze: DataFrame) -> DataFrame:
    lead_date = C.parse_date("lead_date")
    conv = C.parse_date("conversion_date")
    return bronze.select(
        "lead_id", "customer_id", "campaign_id",
        lead_date.alias("lead_date"),
        C.null_if(conv, conv < lead_date).alias("conversion_date"),
        C.norm_label("lead_source").alias("lead_source"),
        "landing_page",
        C.clean_percent("discount_offered_pct").alias("discount_offered_pct"),
        C.to_number("lead_score").alias("lead_score"),
        C.map_label("observed_region", C.REGION_MAP).alias("observed_region"),
        C.parse_bool("converted_30d").alias("converted_30d"),
        C.clean_currency("acquisition_cost_usd").alias("acquisition_cost_usd"),
    )


def clean_sessions(bronze: DataFrame) -> DataFrame:
    pages = C.to_number("pages_viewed")
    tos = C.to_number("time_on_site_sec")
    return bronze.select(
        "session_id", "customer_id", "campaign_id",
        C.parse_date("session_date").alias("session_date"),
        C.map_label("device", C.DEVICE_MAP).alias("device"),
        C.map_label("channel_group", C.CHANNEL_MAP).alias("channel_group"),
        C.map_label("geo_region", C.REGION_MAP).alias("geo_region"),
        C.null_if(pages, pages <= 0).alias("pages_viewed"),
        C.null_if(tos, (tos <= 0) | (tos > 86400)).alias("time_on_site_sec"),
        C.parse_bool("bounce").alias("bounce"),
        C.parse_bool("add_to_cart").alias("add_to_cart"),
        C.parse_bool("checkout_started").alias("checkout_started"),
    )


def clean_transactions(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "order_id", "customer_id",
        C.parse_date("order_date").alias("order_date"),
        C.map_label("product_category", C.CATEGORY_MAP).alias("product_category"),
        C.to_number("units").alias("units"),
        C.clean_currency("revenue_usd").alias("revenue_usd"),
        C.clean_percent("discount_pct").alias("discount_pct"),
        C.norm_label("payment_type").alias("payment_type"),
        C.parse_bool("returned_flag").alias("returned_flag"),
        C.map_label("marketing_channel_last_touch", C.CHANNEL_MAP).alias("marketing_channel_last_touch"),
    )


CLEANERS = {
    "customers": clean_customers,
    "campaigns": clean_campaigns,
    "leads": clean_leads,
    "sessions": clean_sessions,
    "transactions": clean_transactions,
}
