import re

import pytest

from campanula.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=10):
    w = words(text)
    hit, found = set(), set()
    for i, t in items:
        v = words(t)
        for k in range(max(1, len(v) - window + 1) if v else 0):
            part = v[k:k + window]
            for a in range(len(w) - len(part) + 1):
                if w[a:a + len(part)] == part:
                    hit.update(range(a, a + len(part)))
                    if i is not None:
                        found.add(str(i))
    return len(w), len(hit), len(found), D.sha256_of(list(found)), bool(hit)


@pytest.mark.parametrize("block_chars", [20_000_000, 4000])
def test_against_brute_force(both, spark, block_chars, documents):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    odd = [(None, "no id here"), (1001, "repeat repeat"), (1002, None), (1003, "..."), (1001, "repeat repeat"), (1004, "Wort wort WORT wört"), (1005, "café")]
    bench = bench.unionByName(spark.createDataFrame(odd, "item_id long, text string"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    rows = [r for r in both.where("doc_id < 1000900").collect() if len(r.text or "") < 4000]
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")
    got = D.find_contamination(docs, bench, block_chars=block_chars)
    got = {r.doc_id: r.contamination for r in got.collect()}
    hits = 0
    for r in rows:
        g, want = got[r.doc_id], brute(r.text, items)
        n_hit = sum(x["last"] - x["first"] + 1 for x in g["runs"])
        assert (g.n_words, n_hit, len(g["items"]), D.sha256_of(list(g["items"])), n_hit > 0) == want, r
        hits += want[4]
    assert hits > 3


def test_digest_spans_and_filter(spark, edge, empty):
    bench = spark.createDataFrame([(5, "Alpha, beta GAMMA"), (6, "no id here")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x ALPHA beta-gamma. y"), (2, "alpha beta"), (3, None), (4, "")], "doc_id long, text string")
    out = {r.doc_id: r for r in D.contamination_digest(docs, bench).collect()}
    assert (out[1].n_words, out[1].n_hit, out[1].n_items, out[1].contaminated) == (5, 3, 1, True)
    assert out[1].items_sha256 == D.sha256_of(["5"]) and not out[2].contaminated and out[3].n_words == 0
    s = {r.doc_id: r.spans for r in D.contamination_spans(D.find_contamination(docs, bench)).collect()}
    assert [(x["first"], x["last"]) for x in s[1]] == [(2, 18)] and s[3] == []
    kept = D.drop_contaminated(edge, bench)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 1
    assert D.contamination_digest(empty, bench).count() == 0
    assert D.contamination_digest(edge, bench.where("1 = 0")).where("contaminated").count() == 0
