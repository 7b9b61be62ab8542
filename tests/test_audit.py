"""AUD-06: match rates of several relations in one pass."""

from campanula.operators import audit as AU


def test_rates_nulls_hot_keys_and_empty(spark):
    fact = spark.sql("SELECT CASE WHEN id < 70 THEN 'hot' WHEN id < 80 THEN NULL ELSE cast(id AS string) END AS c, cast(id % 3 AS int) AS k FROM range(100)")
    dim = spark.sql("SELECT * FROM VALUES ('hot', 0), ('hot', 1), ('85', NULL), (NULL, 1), ('zz', 7) AS t(c, k)")
    none = fact.filter("1 = 0")
    got = {r.relation: (r.match_rate_pct, r.n_rows) for r in AU.match_rates({
        "by_c": (fact, "c", dim, "c"), "by_k": (fact, "k", dim, "k"), "empty_fact": (none, "c", dim, "c"),
        "empty_dim": (fact, "c", none, "c")}).collect()}
    assert got == {"by_c": (71.0, 100), "by_k": (67.0, 100), "empty_fact": (None, 0), "empty_dim": (0.0, 100)}


def test_one_scan_a_fact(spark, tmp_path):
    spark.sql("SELECT id AS a, id % 7 AS b FROM range(50)").write.parquet(str(tmp_path / "fact"))
    fact, dim = spark.read.parquet(str(tmp_path / "fact")), spark.sql("SELECT id AS a, id AS b FROM range(9)")
    out = AU.match_rates({"a": (fact, "a", dim, "a"), "b": (fact, "b", dim, "b")})
    assert out._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
