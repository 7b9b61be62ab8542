"""KPI cube over month, channel and region (P-20).

Each fact table is reduced once to cells of the finest grain (month, channel,
region); a cell holds sums and counts only, so every coarser slice is a sum of
cells.  The grouping sets run over the cells, not over rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS = ("month", "channel", "region")
MEASURES = ("leads", "conversions", "acquisition_cost", "sessions", "checkouts", "orders", "units", "revenue", "returns")
UNKNOWN = "Unknown"


def _cells(rows: DataFrame, measures: dict) -> DataFrame:
    """One fact table at the finest grain, with zeroes for the measures of the others."""
    got = rows.groupBy(*DIMENSIONS).agg(*[m.alias(k) for k, m in measures.items()])
    return got.select(*DIMENSIONS, *[(F.col(k) if k in measures else F.lit(0)).cast("decimal(30,2)").alias(k) for k in MEASURES])


def _dims(date: str, channel: str, region) -> list:
    """Month, channel and region of a row; a missing one is a member of its own."""
    return [F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(UNKNOWN)).alias("month"),
            F.coalesce(F.col(channel), F.lit(UNKNOWN)).alias("channel"), F.coalesce(region, F.lit(UNKNOWN)).alias("region")]


def kpi_cells(leads: DataFrame, sessions: DataFrame, transactions: DataFrame, campaigns: DataFrame, customers: DataFrame) -> DataFrame:
    """Measures by month, channel and region: leads by their campaign's channel and the
    observed region, sessions by channel group and region, orders by last touch and the
    customer's region.  An order without a known customer has region ``Unknown``.

    Facts are summed by key before a lookup, so a hot campaign or customer, and rows
    without one, meet the lookup as a few rows."""
    def one(flag):
        return F.count_if(F.coalesce(F.col(flag), F.lit(False)))
    by_campaign = leads.groupBy("campaign_id", F.trunc("lead_date", "month").alias("date"), "observed_region").agg(
        F.count(F.lit(1)).alias("n"), one("converted_30d").alias("c"), F.sum(F.col("acquisition_cost_usd").cast("decimal(20,2)")).alias("a"))
    channels = campaigns.filter(F.col("campaign_id").isNotNull()).select("campaign_id", "channel")
    lead = _cells(by_campaign.join(channels, "campaign_id", "left").select(*_dims("date", "channel", F.col("observed_region")), "n", "c", "a"),
                  {"leads": F.sum("n"), "conversions": F.sum("c"), "acquisition_cost": F.coalesce(F.sum("a"), F.lit(0))})
    seen = _cells(sessions.select(*_dims("session_date", "channel_group", F.col("geo_region")), "checkout_started"),
                  {"sessions": F.count(F.lit(1)), "checkouts": one("checkout_started")})
    by_customer = transactions.groupBy("customer_id", F.trunc("order_date", "month").alias("date"), "marketing_channel_last_touch").agg(
        F.count(F.lit(1)).alias("n"), F.sum("units").alias("u"), F.sum(F.col("revenue_usd").cast("decimal(20,2)")).alias("v"),
        one("returned_flag").alias("r"))
    regions = customers.filter(F.col("customer_id").isNotNull()).select("customer_id", "region")
    sold = _cells(by_customer.join(regions, "customer_id", "left")
                  .select(*_dims("date", "marketing_channel_last_touch", F.col("region")), "n", "u", "v", "r"),
                  {"orders": F.sum("n"), "units": F.coalesce(F.sum("u"), F.lit(0)), "revenue": F.coalesce(F.sum("v"), F.lit(0)),
                   "returns": F.sum("r")})
    return lead.unionByName(seen).unionByName(sold).groupBy(*DIMENSIONS).agg(*[F.sum(k).alias(k) for k in MEASURES])


def kpi_cube(cells: DataFrame) -> DataFrame:
    """All slices of the cells: 'all' stands for every member of a dimension.

    Rates are null without a denominator.  ``band`` compares a slice's conversion
    with the whole's: green at or above it, amber within a tenth below, else red;
    no leads, no band.  ``lift`` is conversion over the whole's."""
    cubed = cells.cube(*DIMENSIONS).agg(F.grouping_id().alias("_g"), *[F.sum(k).alias(k) for k in MEASURES])
    # an empty table has no slice, not even the whole
    slices = cubed.filter(F.col("leads").isNotNull()).select(
        *[F.when(F.col("_g").bitwiseAND(1 << (len(DIMENSIONS) - 1 - i)) > 0, "all").otherwise(F.col(d)).alias(d)
          for i, d in enumerate(DIMENSIONS)], "_g", *[F.col(k).cast("double").alias(k) for k in MEASURES])
    whole = cells.agg(F.try_divide(F.sum("conversions").cast("double"), F.sum("leads").cast("double"))).scalar()
    lcr = F.try_divide("conversions", "leads")
    counts = {"leads", "conversions", "sessions", "checkouts", "orders", "returns"}
    return slices.withColumn("lcr", lcr).withColumn("_whole", whole).select(
        *DIMENSIONS, F.col("_g").cast("int").alias("level"),
        *[F.col(k).cast("bigint").alias(k) if k in counts else F.col(k) for k in MEASURES], "lcr",
        F.try_divide("lcr", "_whole").alias("lift"), F.try_divide("acquisition_cost", "leads").alias("cost_per_lead"),
        F.try_divide("revenue", "orders").alias("aov"), F.try_divide("checkouts", "sessions").alias("checkout_rate"),
        F.try_divide("returns", "orders").alias("return_rate"),
        F.when(F.col("lcr") >= F.col("_whole"), "green").when(F.col("lcr") >= F.col("_whole") * 0.9, "amber")
        .when(F.col("lcr").isNotNull(), "red").alias("band"))
