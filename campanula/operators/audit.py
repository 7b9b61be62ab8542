"""Audit operators (AUD-01 .. AUD-07): counters in one pass per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campanula.functions import clean as C


def _long(df_one_row: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    return df_one_row.unpivot([], list(names), label, value)


def dup_count(df: DataFrame, key: str) -> Column:
    """AUD-01 as an aggregate expression: rows beyond the first per key.

    Null keys form one group of their own (as in pandas ``duplicated``).
    """
    has_null = F.max(F.col(key).isNull().cast("bigint"))
    return (F.count(F.lit(1)) - F.countDistinct(key) - has_null).cast("bigint")


def rule_counts(df: DataFrame, rules: Mapping[str, Column], table: str | None = None) -> DataFrame:
    """AUD-04/05: count rows matching each rule, all rules in one aggregate.

    Returns a long table ``(check_name, n)`` (plus ``table_name``).
    """
    aggs = [F.count_if(F.coalesce(pred, F.lit(False))).cast("bigint").alias(name)
            for name, pred in rules.items()]
    out = _long(df.agg(*aggs), list(rules), "check_name", "n")
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "check_name", "n")
    return out


def null_counts(df: DataFrame, cols: Sequence[str], table: str | None = None) -> DataFrame:
    """AUD-03: null count per column, one aggregate, long output."""
    aggs = [F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols]
    out = _long(df.agg(*aggs), list(cols), "column_name", "n_null")
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "column_name", "n_null")
    return out


def match_rates(relations: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """AUD-06: percentage of fact rows whose key exists in a dimension, of all
    ``relation -> (fact, key, dimension, dimension key)`` together.

    A fact table is scanned once for all of its keys, a dimension once for each of
    its key columns.  Rows are counted per key before the shuffle and meet the
    distinct keys of the dimensions as counts, so a hot key is a few rows.  Null
    keys, never matched, become one row a task and relation the same way.  A
    relation over an empty fact table has no rate."""
    facts: dict[int, tuple[DataFrame, list[tuple[str, str]]]] = {}
    dims: dict[tuple[int, str], tuple[DataFrame, list[str]]] = {}
    for name, (fact, key, dim, dim_key) in relations.items():
        facts.setdefault(id(fact), (fact, []))[1].append((name, key))
        dims.setdefault((id(dim), dim_key), (dim, []))[1].append(name)

    def keys(df: DataFrame, named: Sequence[tuple[str, str]]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(n).alias("relation"), F.col(k).cast("string").alias("k")) for n, k in named])
        return df.select(F.explode(pairs).alias("p")).select("p.*")

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    counts = union([keys(*f) for f in facts.values()]).groupBy("relation", "k").agg(F.count(F.lit(1)).alias("n"))
    known = union([keys(dim.select(k).filter(F.col(k).isNotNull()).distinct(), [(n, k) for n in names]) for (_, k), (dim, names) in dims.items()])
    met = counts.join(known.withColumn("hit", F.lit(True)), ["relation", "k"], "left")
    rates = met.groupBy("relation").agg(F.sum("n").alias("_n"), F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("_hit"))
    every = counts.sparkSession.createDataFrame([(n,) for n in relations], "relation string")
    return every.join(F.broadcast(rates), "relation", "left").select(  # one row per relation
        "relation", (F.try_divide("_hit", "_n") * 100).alias("match_rate_pct"), F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_rows"))


def quality_row(df: DataFrame, table: str, a: Column, b: Column) -> DataFrame:
    """AUD-07: score = mean of two validity shares, x100, rounded to 1 place."""
    score = F.round((F.avg(F.coalesce(a, F.lit(False)).cast("double"))
                     + F.avg(F.coalesce(b, F.lit(False)).cast("double"))) / 2 * 100, 1)
    return (df.agg(score.alias("score"))
            .select(F.lit(table).alias("table_name"), "score",
                    C.band("score", [90, 70], ["Healthy", "Warning", "Critical"]).alias("status")))


def quality_scores(silver: Mapping[str, DataFrame]) -> DataFrame:
    """AUD-07 + P-17: quality scores for all five tables."""
    cu, ca, le = silver["customers"], silver["campaigns"], silver["leads"]
    se, tx = silver["sessions"], silver["transactions"]
    far_future = F.lit("9999-12-31").cast("date")
    rows = [
        quality_row(cu, "customers", F.col("age").isNotNull(),
                    F.coalesce(F.col("gender") != "unknown", F.lit(True))),
        quality_row(ca, "campaigns", F.col("budget_usd").isNotNull(),
                    F.col("clicks") <= F.col("impressions")),
        quality_row(le, "leads", F.col("customer_id").isNotNull(),
                    F.col("lead_date") <= F.coalesce(F.col("conversion_date"), far_future)),
        quality_row(se, "sessions", F.col("customer_id").isNotNull(),
                    F.col("pages_viewed").isNotNull() & F.col("time_on_site_sec").isNotNull()),
        quality_row(tx, "transactions", F.col("revenue_usd") > 0, F.col("units") > 0),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
