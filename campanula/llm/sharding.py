"""Shards by jump consistent hashing.

The shard of a row depends on its key and the number of shards alone; there is
no ring table and nothing to keep between runs.  Appending a shard moves one
key in n+1, and only into the new shard (Lamping and Veach, 2014).

Rows also get a *slot*: a number without gaps from 0 within the shard.  A shard
is never ordered in one task: rows are cut into ``buckets`` hash buckets a
shard, numbered inside a bucket, and shifted by the sizes of the buckets before
it.  The table of bucket sizes has at most ``shards * buckets`` rows.  Rows that
are equal in all ordering columns (one id on a third of all rows, say) are dealt
into ``salts`` groups by their place in the written table and counted before
they are shuffled, so no task gets all of them.

Null keys hash like a value of their own; repeated keys share a shard and get a
slot each; among rows that are equal in every column it does not matter which
slot each gets (ties).  A null text counts as the empty text; very long texts
are only measured, never shuffled.  An empty table gives an empty result, and
columns of the input beside id and text are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campanula.session import materialize

from .common import whole_text

_MULTIPLIER = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, all keys at once."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    state = keys.astype(np.uint64, copy=True)
    out = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    jump = np.zeros(len(state), np.int64)
    while len(live):
        out[live] = jump
        state = state * _MULTIPLIER + np.uint64(1)
        jump = ((jump + 1) * (float(1 << 31) / ((state >> np.uint64(33)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
        on = jump < shards
        live, state, jump = live[on], state[on], jump[on]
    return out


def shard_of(*key: Column, shards: int) -> Column:
    """Shard (int, from 0) of a key of one or more columns of any type."""
    @F.pandas_udf(T.IntegerType())
    def place(h: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(h.to_numpy(np.int64).view(np.uint64), shards), index=h.index, dtype="int32")
    parts = [c.cast("string") for c in key]
    return place(F.xxhash64(*(F.coalesce(F.concat(F.lit("="), p), F.lit("null")) for p in parts)))


def with_slots(df: DataFrame, shard_col: str, order: list[str], buckets: int = 1024, salts: int = 64,
               slot_col: str = "slot") -> DataFrame:
    """``df`` with a gapless number from 0 within each shard.

    The rows are written once with their salts, because they are read twice.
    Slots of rows that differ in ``order`` do not depend on the salts."""
    rows = materialize(df.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts))))
    same = [shard_col, *order, "__salt"]
    groups = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("__n")).withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = groups.groupBy(shard_col, "__bucket").agg(F.sum("__n").alias("__size"))
    earlier = Window.partitionBy(shard_col).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard_col, "__bucket", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(shard_col, "__bucket").orderBy(*order, "__salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (groups.join(starts, [shard_col, "__bucket"])
              .select(*[F.col(c).alias(f"__of_{c}") for c in same],
                      (F.col("__start") + F.coalesce(F.sum("__n").over(inside), F.lit(0))).alias("__first")))
    on = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in same]
    return (rows.join(firsts, on)
            .withColumn(slot_col, F.col("__first") + F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0))) - 1)
            .select(*df.columns, slot_col))


def shard_documents(documents: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                    buckets: int = 1024) -> DataFrame:
    """Per document: size, checksum, shard, slot and the shard it would have
    with one shard more.  Only these narrow rows are shuffled, never texts."""
    text = whole_text(text_col)
    rows = documents.select(
        F.col(id_col), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    rows = rows.withColumn("shard", shard_of(F.col(id_col), shards=shards)) \
               .withColumn("grown_shard", shard_of(F.col(id_col), shards=shards + 1))
    out = with_slots(rows, "shard", [id_col, "size", "text_crc32"], buckets)
    return out.select(id_col, "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
