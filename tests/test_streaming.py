"""The streaming roll-up equals the batch roll-up over the same raw rows."""

import os
import tempfile

from pyspark.sql import functions as F

from campanula.operators.abt import tx_per_customer
from campanula.operators.tables import clean_transactions
from campanula.sources.testdata import bronze_transactions
from campanula.streaming.rollup import latest_totals, start_rollup
from harness import SF_SMALL
from harness import compare


def test_stream_rollup_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="campanula-stream-")
    src, log, ckpt = (os.path.join(root, d) for d in ("src", "log", "ckpt"))
    raw = bronze_transactions(spark, SF_SMALL)
    # land the raw rows in three arrivals
    parts = raw.withColumn("_b", F.abs(F.xxhash64("order_id", "product_category", "revenue_usd")) % 3)
    for b in range(3):
        parts.filter(F.col("_b") == b).drop("_b").write.mode("overwrite").parquet(os.path.join(src, f"arrival={b}"))
    q = start_rollup(spark, src + "/*", log, ckpt)
    q.awaitTermination(300)
    got = latest_totals(spark, log).toPandas()
    exp = tx_per_customer(clean_transactions(raw)).toPandas()
    ok, msg = compare(got, exp)
    assert ok, msg
