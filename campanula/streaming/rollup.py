"""Incremental per-customer transaction roll-up (AGG-03) with Structured
Streaming.

New raw transaction files landing in a folder are cleaned with the same
column expressions as the batch silver table, then aggregated per
customer in the state store.  ``update`` mode emits only the customers
touched by each micro-batch; ``foreachBatch`` writes them as an
append-only change log (one folder per batch id, idempotent on replay),
and ``latest_totals`` reads the newest row per customer from that log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campanula.operators.tables import clean_transactions
from campanula.sources.files import RAW_COLUMNS, string_schema


def raw_transactions_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                            max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of raw (all-string) transaction rows from files under ``path``."""
    reader = spark.readStream.schema(string_schema(RAW_COLUMNS["transactions"])).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def customer_rollup(stream: DataFrame) -> DataFrame:
    """Running per-customer totals of cleaned transactions (stateful)."""
    tx = clean_transactions(stream)
    return (tx.filter(F.col("customer_id").isNotNull()).groupBy("customer_id")
            .agg(F.count("order_id").alias("total_orders"),
                 F.coalesce(F.sum("revenue_usd"), F.lit(0.0)).alias("total_revenue"),
                 F.coalesce(F.sum("units"), F.lit(0.0)).alias("total_units"),
                 F.sum(F.col("returned_flag").cast("bigint")).alias("total_returned"),
                 F.max("order_date").alias("last_order_date")))


def start_rollup(spark: SparkSession, source: str, changelog: str, checkpoint: str,
                 available_now: bool = True, fmt: str = "parquet"):
    """Start the roll-up; each micro-batch's updated customers are appended
    to ``changelog/batch_id=<n>`` (overwrite of that one folder, so a
    replayed batch rewrites itself instead of duplicating)."""
    rollup = customer_rollup(raw_transactions_stream(spark, source, fmt))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(f"{changelog.rstrip('/')}/batch_id={batch_id}"))

    w = (rollup.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(write_batch))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def latest_totals(spark: SparkSession, changelog: str) -> DataFrame:
    """Current totals: the newest change-log row per customer."""
    log = spark.read.parquet(changelog)
    newest = log.groupBy("customer_id").agg(F.max("batch_id").alias("batch_id"))
    return log.join(newest, ["customer_id", "batch_id"]).drop("batch_id")
