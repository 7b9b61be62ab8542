"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by Spark's own reader (the folder may be remote)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(name: str) -> Column:
    """The text column as string, null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc32_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(modulus)


def smallest_hashes(labelled: DataFrame, per_class: int, seed: str) -> DataFrame:
    """Of ``labelled`` (``__id``, ``__label`` 0 or 1; ids once) at most ``per_class`` ids of either label."""
    order = [F.xxhash64(F.col("__id").cast("string"), F.lit(seed)), F.col("__id")]
    parts = [labelled.where(F.col("__label") == v).orderBy(*order).limit(per_class) for v in (0, 1)]
    return parts[0].unionByName(parts[1]).select("__id", "__label")


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int,
                    id_col: str = "doc_id", text_col: str = "text", max_chars: int = 200_000) -> list[tuple[str, int]]:
    """At most ``per_class`` labelled texts of either class, on the driver.

    The ids are chosen by the smallest hash of the id among those where
    ``allowed`` holds and whose document is there, so the choice does not
    depend on row order or on how the tables are partitioned, and a table with
    few of the labelled ids still gives a full sample.  An id on several
    documents counts once, with its least text, so at most ``2 * per_class``
    texts of at most ``max_chars`` characters reach the driver.  Texts over
    ``max_chars`` are not used for fitting (they are still scored whole).  This
    is the only place where a model sees labels.
    """
    lab = (labels.where(allowed & F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label).cast("int")).alias("__label"),
                                                     F.min(F.col(label).cast("int")).alias("__least"))
           .where(F.col("__label") == F.col("__least")).drop("__least"))
    texts = (documents.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
             .where(F.col("__text").isNotNull() & (F.length("__text") <= max_chars)))
    chosen = smallest_hashes(lab.join(texts.select("__id"), "__id", "left_semi"), per_class, "sample")
    rows = (texts.join(F.broadcast(chosen), "__id")
            .groupBy("__id", "__label").agg(F.min("__text").alias("__text")).collect())
    rows = [(r["__id"], r["__text"], r["__label"]) for r in rows]
    rows.sort(key=lambda r: (str(r[0]), r[1]))
    return [(r[1], r[2]) for r in rows]
