"""Isotonic regression from mergeable blocks (P-12).

Pooling adjacent violators gives the same blocks in whatever order neighbours
are pooled, so it can be done piecewise: the blocks are numbered in score order,
cut into buckets of ``BUCKET`` consecutive blocks, and each bucket is pooled by
itself.  A round with buckets shifted by half a bucket then pools across the old
cuts.  When a plain and a shifted round both leave the number of blocks as it
was, every pair of neighbours has met inside a bucket and the fit is done.

No task holds more than ``BUCKET`` blocks and no score list reaches the driver;
it only receives the number of blocks of a round.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campanula.operators import ranks as RK
from campanula.session import materialize

BUCKET = 1 << 16
_BLOCK = "lo double, hi double, weight double, total double"


def pool(blocks: pd.DataFrame) -> pd.DataFrame:
    """Pool neighbours of one bucket until the means rise strictly."""
    done: list[tuple[float, float, float, float]] = []
    for lo, hi, weight, total in blocks.sort_values("lo")[["lo", "hi", "weight", "total"]].itertuples(index=False, name=None):
        while done and done[-1][3] / done[-1][2] >= total / weight:
            before = done.pop()
            lo, weight, total = before[0], before[2] + weight, before[3] + total
        done.append((lo, hi, weight, total))
    return pd.DataFrame(done, columns=["lo", "hi", "weight", "total"])


def fit(df: DataFrame, score: str = "score", label: str = "label", weight: str | Column | None = None,
        bucket: int = BUCKET) -> DataFrame:
    """The blocks of the rising step function nearest to ``label`` in least squares.

    Returns ``lo, hi`` (first and last score), ``weight``, ``value`` (mean label),
    one row a block.  Rows without a score or label (null, NaN) or of weight
    zero or below are left out; equal scores are one point; an empty table has
    no block."""
    if bucket < 2:
        raise ValueError("a bucket holds two blocks at least")
    w = F.lit(1.0) if weight is None else (F.col(weight) if isinstance(weight, str) else weight).cast("double")
    rows = df.select(F.nanvl(F.col(score).cast("double"), F.lit(None)).alias("lo"),
                     F.nanvl(F.col(label).cast("double"), F.lit(None)).alias("_y"), w.alias("_w"))
    points = (rows.filter(F.col("lo").isNotNull() & F.col("_y").isNotNull() & (F.col("_w") > 0)).groupBy("lo")
              .agg(F.sum("_w").alias("weight"), F.sum(F.col("_w") * F.col("_y")).alias("total")))
    blocks = materialize(points.select("lo", F.col("lo").alias("hi"), "weight", "total"))
    n, shift, quiet = blocks.count(), 0, 0
    while n > 1 and quiet < 2:
        numbered = RK.prefix_sum(blocks, ["lo"])
        cut = F.floor((F.col("_cum_before") + shift) / bucket).alias("_bucket")
        blocks = materialize(numbered.select("lo", "hi", "weight", "total", cut).groupBy("_bucket").applyInPandas(pool, _BLOCK))
        before, n = n, blocks.count()
        if before + shift <= bucket:  # one bucket held them all
            break
        quiet = quiet + 1 if n == before else 0
        shift = bucket // 2 - shift
    return blocks.select("lo", "hi", "weight", (F.col("total") / F.col("weight")).alias("value"))


def apply(df: DataFrame, blocks: DataFrame, score: str = "score", out: str = "calibrated") -> DataFrame:
    """Add the fitted value: a block's own between its ends, a straight line between
    two blocks, the outermost values beyond them; null without a score or block.

    Scores meet their blocks by position in one ordered pass over the distinct
    scores and the blocks, then by equality."""
    numbered = materialize(RK.prefix_sum(blocks, ["lo"]).select(F.col("_cum").alias("_i"), "lo", "hi", "value"))
    x = F.nanvl(F.col(score).cast("double"), F.lit(None))
    points = df.select(x.alias("_x")).filter(F.col("_x").isNotNull()).distinct().withColumn("_block", F.lit(0))
    both = points.unionByName(numbered.select(F.col("lo").alias("_x"), F.lit(1).alias("_block")))
    placed = (RK.prefix_sum(both, ["_x", F.col("_block").desc()], "_block").filter("_block = 0")
              .select("_x", F.greatest(F.col("_cum"), F.lit(1)).alias("_i")))
    after = numbered.select((F.col("_i") - 1).alias("_i"), F.col("lo").alias("_lo2"), F.col("value").alias("_value2"))
    slope = (F.col("_value2") - F.col("value")) / (F.col("_lo2") - F.col("hi"))
    fitted = (F.when((F.col("_x") <= F.col("hi")) | F.col("_lo2").isNull(), F.col("value"))
              .otherwise(F.col("value") + (F.col("_x") - F.col("hi")) * slope))
    values = placed.join(numbered, "_i").join(after, "_i", "left").select("_x", fitted.alias(out))
    return df.withColumn("_x", x).join(values, "_x", "left").drop("_x")
