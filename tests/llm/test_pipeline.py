"""Each stage against a brute-force version of it, on what the one before kept."""

import pytest
from test_decontaminate import brute as hits
from test_line_dedup import brute as repeated_lines
from test_packing import check as check_packing
from test_quality_rules import plain as quality
from test_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline as P
from campanula.llm import quality_rules as Q
from campanula.llm.common import read_table
from campanula.llm.queries import default_tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = read_table(spark, SF, "documents").where("length(text) < 1200")
    bench = [r.text for r in read_table(spark, SF, "benchmark").collect()]
    columns = docs.columns
    filler = " ".join(f"planted{k}" for k in range(30))
    second = " ".join(f"copied{k}" for k in range(30))
    more = [(5001, f"{filler} one\n{second} two"), (5002, f"{filler} one\n{second}s two"),
            (5003, f"Entirely {bench[0]} " + " ".join(f"leak{k}" for k in range(30))),
            (5004, ""), (5005, None), (5006, " ".join(f"other{k}" for k in range(400))), (5007, " ".join(f"other{k}" for k in range(399)) + " lastly")]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "planted", len(t or "")) for i, t in more], docs.schema))
    out = [docs]
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    assert all(d.columns == columns for d in out[:-1])
    return [d.collect() for d in out], docs


def test_quality(stages, spark):
    (before, after, *_), docs = stages
    rules = Q.learn_rules(Q.labelled_stats(docs, read_table(spark, SF, "labels")))
    stats = {r.doc_id: r["__stats"].asDict() for r in Q.with_text_stats(docs).collect()}
    want = {r.doc_id for r in before if not quality(r.text)[-1] and not any(Q.covers(x, stats[r.doc_id]) for x in rules)}
    assert {r.doc_id for r in after} == want and 0 < len(after) < len(before)


def test_lines(stages):
    (_, before, after, *_), _ = stages
    gone = repeated_lines([(r.doc_id, r.text) for r in before])
    want = {}
    for r in before:
        lines = r.text.split("\n")
        out = gone.get((r.doc_id, r.text), set())
        kept = [x for k, x in enumerate(lines) if k not in out]
        size = [len("".join("".join(x).split())) for x in (lines, kept)]
        if not out or size[1] and size[1] >= 0.2 * size[0]:
            want[r.doc_id] = "\n".join(kept)
    assert {r.doc_id: r.text for r in after} == want and 5001 in want and 5002 not in want


def test_near_duplicates(stages):
    (_, _, before, after, *_), _ = stages
    fps = {r.doc_id: plain_fingerprint(r.text) for r in before}
    root = plain_components(fps.values(), 2)
    first = {}
    for d in sorted(fps):
        first.setdefault(root[fps[d]], d)
    assert sorted(r.doc_id for r in after) == sorted(first.values())


def test_decontamination(stages, spark):
    (_, _, _, before, after, _), _ = stages
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    want = {r.doc_id for r in before if not hits(r.text, items)[-1]}
    assert {r.doc_id for r in after} == want and 5003 not in want and 5003 in {r.doc_id for r in before}


def test_packing(stages):
    (*_, before, pieces), _ = stages
    tokenizer = Tokenizer.from_file(default_tokenizer())
    tokenizer.encode_special_tokens = True
    assert check_packing(before, pieces, tokenizer, 1024) < 0.05


def test_run(spark):
    rows = P.run(spark, SF).collect()
    assert len(rows) > 20 and [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "packing"]
