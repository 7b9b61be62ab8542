from pyspark.sql import functions as F

from campanula.llm import sharding


def hot(spark, n=6000):
    """A third of the rows is one row repeated, a third one id with other texts, the rest differ."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"),
        F.lit(1).alias("__bucket"), F.lit(2).alias("slot"))


def test_equal_rows_get_gapless_slots(spark):
    df = hot(spark)
    out = sharding.shard_documents(df, 5, buckets=3)
    got = out.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b"), F.countDistinct("slot").alias("d")).collect()
    assert sum(r.n for r in got) == 6000 and all((r.a, r.b, r.d) == (0, r.n - 1, r.n) for r in got)


def test_equal_rows_are_dealt_out(spark):
    """No group of the window that numbers rows holds more than its share of the repeated row."""
    rows = sharding.materialize(hot(spark).select("doc_id", "text", F.lit(0).alias("shard"))
                                .withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(64))))
    most = rows.groupBy("doc_id", "text", "__salt").count().agg(F.max("count")).first()[0]
    assert most < 2000 / 64 * 4


def test_slots_of_different_rows_do_not_depend_on_the_partitions(spark):
    df = hot(spark).where("doc_id <> 7")
    one = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_documents(df.repartition(2), 5).collect()}
    two = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_documents(df.repartition(7), 5).collect()}
    assert one == two and len(one) == 2000
