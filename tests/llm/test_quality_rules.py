import re
from collections import Counter

from pyspark.sql import functions as F

from campanula.llm import quality_rules as Q


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(windows)
    covered = set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            covered.update(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed


def test_counts_against_plain_python(both):
    out = Q.with_text_stats(both).withColumn("f", Q.base_failed(F.col("__stats")))
    n = 0
    for r in out.collect():
        s = r["__stats"]
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words, r.f) == plain(r.text), (r.text or "")[:80]
        n += s.n_repeat_words > 0
    assert n > 3


def test_digest_separates_the_labels(documents, spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rules = Q.learn_rules(Q.labelled_stats(docs, labels, per_class=60))
    assert rules
    got = Q.judge(docs.join(labels, "doc_id"), rules).groupBy("quality", "__kept").count().collect()
    n = {(r.quality, r["__kept"]): r["count"] for r in got}
    assert n[0, False] > 9 * n.get((0, True), 0) and n[1, True] > 9 * n.get((1, False), 0)
    out = Q.quality_digest(docs, labels)
    assert dict(out.dtypes) | {"rule": "int"} == {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
                                                  "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean",
                                                  "kept": "boolean", "rule": "int"}
    assert out.where("base_failed and kept").count() == 0


def test_the_list_is_ordered_and_pruned():
    rows = [({f: 0.0 for f in Q.FEATURES} | {"upper_share": (i % 10) / 10, "n_words": i}, int(i % 10 < 8)) for i in range(300)]
    rules = Q.learn_rules(rows)
    assert len(rules) == 1 and len(rules[0]) == 1 and str(rules[0][0]).startswith("upper_share > 0.7")
    assert Q.learn_rules([]) == [] and Q.learn_rules([(rows[0][0], 1)] * 30) == []


def test_native_plan(documents):
    plan = Q.judge(documents, [(Q.Condition("n_words", False, 3.0),)])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_odd_input(edge, empty, spark):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert Q.quality_digest(empty, none).count() == 0
    fine = edge.limit(1).selectExpr("77L doc_id", "array_join(transform(sequence(1, 40), i -> concat('word', i)), ' ') text",
                                    "lang", "source", "n_chars", "kept", "shard")
    kept = Q.keep_good(edge.unionByName(fine), none)
    assert kept.columns == edge.columns and [r.doc_id for r in kept.collect()] == [77]
