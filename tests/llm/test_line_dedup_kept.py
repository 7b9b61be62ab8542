import corpus_pipeline as P
from campanula.llm import line_dedup as L


def test_what_is_left_stays(spark):
    shared = [f"shared line number {k} of a very common passage {k * k} {'abcdefghij'[k % 10] * (3 + k)}" for k in range(60)]
    own = "\n".join(f"{w} occurs in this one document and nowhere else at all" for w in ("alpha", "one beta", "some gamma rays", "the river delta water"))
    rows = [(1, "\n".join(shared)), (2, "\n".join([*shared[:40], own, *shared[40:]])), (3, "\n".join(shared[5:50])), (4, shared[0] + "\n\t \n")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert len(own) < 0.2 * len(rows[1][1])
    out = {r.doc_id: r for r in dict(P.STAGES)["line_dedup"](spark, df, "").collect()}
    assert set(out) == {1, 2} and out[2].text == own and out[2].n_chars == len(own)
    assert {r.doc_id: r.kept for r in L.line_dedup_digest(df).collect()} == {1: True, 2: True, 3: False, 4: False}
