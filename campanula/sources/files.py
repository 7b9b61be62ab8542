"""SRC-01 / SRC-02 / SNK-01: raw CSV scan, stage re-read, stage write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: raw column lists of the five exports (data dictionary) ---
RAW_COLUMNS = {
    "customers": ("customer_id", "gender", "age", "city", "region", "signup_date",
                  "preferred_device", "loyalty_tier", "email_opt_in", "income_band"),
    "campaigns": ("campaign_id", "campaign_name", "channel", "objective", "start_date", "end_date",
                  "budget_usd", "spend_usd", "target_region", "creative_type", "impressions", "clicks"),
    "leads": ("lead_id", "customer_id", "campaign_id", "lead_date", "lead_source", "landing_page",
              "discount_offered_pct", "lead_score", "observed_region", "converted_30d",
              "conversion_date", "acquisition_cost_usd"),
    "sessions": ("session_id", "customer_id", "campaign_id", "session_date", "device", "channel_group",
                 "geo_region", "pages_viewed", "time_on_site_sec", "bounce", "add_to_cart",
                 "checkout_started"),
    "transactions": ("order_id", "customer_id", "order_date", "product_category", "units",
                     "revenue_usd", "discount_pct", "payment_type", "returned_flag",
                     "marketing_channel_last_touch"),
}
# -----------------------------------------------------------------------------


def string_schema(columns: Sequence[str]) -> T.StructType:
    """Bronze schema: every column a nullable string (no inference pass)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


BAD_RECORD = "_bad_record"


def scan_raw(spark: SparkSession, path: str, table: str | None = None, columns: Sequence[str] | None = None,
             multi_line: bool = False) -> DataFrame:
    """SRC-01: header CSV, quoted commas, UTF-8 BOM tolerated, all strings, checked.

    Every file's header must name the expected columns in their order; another
    header is an error when the rows are read, not a table with shifted columns.
    A record with too few or too many fields stays a row: its whole text is in
    ``_bad_record`` (null for a good one).  Fields that were asked for do not
    decide which records are bad: columns are not pruned in the parser.

    ``multi_line`` reads fields with line breaks; such a file is one task."""
    cols = columns or RAW_COLUMNS[table]
    if BAD_RECORD in cols:
        raise ValueError(f"a column may not be named {BAD_RECORD}")
    return (spark.read.schema(string_schema([*cols, BAD_RECORD]))
            .option("header", True).option("enforceSchema", False).option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_RECORD).option("columnPruning", False)
            .csv(path))


def _is_good(cols: Sequence[str]) -> Column:
    """True for a good record.  Spark refuses a scan of the record text alone (a count
    of such rows), so the first field is read with it."""
    return F.col(BAD_RECORD).isNull() & (F.coalesce(F.col(cols[0]), F.lit("")) >= "")


def read_raw(spark: SparkSession, path: str, table: str | None = None, columns: Sequence[str] | None = None,
             multi_line: bool = False) -> DataFrame:
    """The good records of ``scan_raw``; see ``quarantine`` for the others."""
    rows = scan_raw(spark, path, table, columns, multi_line)
    return rows.filter(_is_good(columns or RAW_COLUMNS[table])).drop(BAD_RECORD)


def quarantine(spark: SparkSession, path: str, table: str | None = None, columns: Sequence[str] | None = None,
               multi_line: bool = False) -> DataFrame:
    """The records of ``scan_raw`` that do not fit: ``file``, ``key`` (first field) and the whole ``record``."""
    rows, cols = scan_raw(spark, path, table, columns, multi_line), columns or RAW_COLUMNS[table]
    return rows.filter(~_is_good(cols)).select(
        F.col("_metadata.file_path").alias("file"), F.col(cols[0]).alias("key"), F.col(BAD_RECORD).alias("record"))


def write_raw(df: DataFrame, path: str, damage: Column | None = None) -> None:
    """Export as CSV files with a header each, nulls as empty fields, spaces kept.

    ``damage`` (1: the last field is missing, 2: there is one field more, else
    whole) makes a faulty export, to rehearse the quarantine."""
    text = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}
    line = F.to_csv(F.struct(*df.columns), text)
    if damage is not None:
        line = (F.when(damage == 1, F.to_csv(F.struct(*df.columns[:-1]), text))
                .when(damage == 2, F.concat(line, F.lit(",stray"))).otherwise(line))
    # records are already text: one column whose name is the header line, with separators no text holds
    df.select(line.alias(",".join(df.columns))).write.mode("overwrite").options(
        header=True, sep="\u0001", quote="\u0002", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                mode: str = "overwrite") -> None:
    """SNK-01: write a derived table as Parquet (one new path per stage)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """SRC-02: re-read a derived stage table."""
    return spark.read.parquet(path)
