"""Samples for fitting are bounded whatever the tables hold."""
from pyspark.sql import functions as F

from campanula.llm import common, quality_rules


def tables(spark, ids, copies=1):
    docs = spark.range(ids).withColumnRenamed("id", "doc_id").withColumn("text", F.concat(F.lit("some words of text "), F.col("doc_id").cast("string")))
    docs = docs.crossJoin(spark.range(copies).drop("id"))
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    return docs, labels


def test_one_id_on_many_rows_is_one_text(spark):
    docs, labels = tables(spark, 2, 3000)
    got = common.labelled_sample(docs, labels, "quality", F.lit(True), 1)
    assert sorted(got) == [("some words of text 0", 0), ("some words of text 1", 1)]
    assert len(quality_rules.labelled_stats(docs, labels, per_class=1)) == 2


def test_a_table_with_few_of_the_labelled_ids_fills_the_sample(spark):
    docs, labels = tables(spark, 100)
    got = common.labelled_sample(docs, labels, "quality", F.lit(True), 40)
    assert len(got) == 80 and sum(y for _, y in got) == 40
    assert len(quality_rules.labelled_stats(docs, labels, per_class=40)) == 80


def test_ids_that_are_null_unlabelled_or_labelled_twice_are_left_out(spark):
    docs = spark.createDataFrame([(None, "x"), (1, None), (2, "two"), (3, "three"), (4, "four"), (4, "FOUR")], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, 1), (2, 0), (3, 0), (3, 1), (4, 1), (4, 1), (9, 1)], "doc_id long, quality int")
    assert sorted(common.labelled_sample(docs, labels, "quality", F.lit(True), 10)) == [("FOUR", 1), ("two", 0)]
    assert common.labelled_sample(docs.where("1 = 0"), labels, "quality", F.lit(True), 10) == []
