import zlib

import numpy as np

from campanula.llm import quality_cnn as Q


def test_pooled_answers_against_a_plain_loop():
    net = Q.ByteNet(width=4, filters=3, stride=7)
    for text in ("", "a", "abc", "The quick brown fox", "éü" * 30, None):
        raw = list((text or "").encode()) + [0] * 3 if text else [0] * 4
        windows = [sum(net.tables[j, raw[i + j]] for j in range(4)) + net.bias for i in range(len(raw) - 3)]
        want = np.stack([np.maximum(np.max(windows[s:s + 7], axis=0), 0) for s in range(0, len(windows), 7)])
        assert np.allclose(net.pooled(text), want, atol=1e-5)
        again = Q.ByteNet.loads(net.dumps())
        assert abs(again.frozen().score(text) - net.score(text)) < 1e-5


def test_gradients_against_differences():
    net = Q.ByteNet(width=3, filters=2, stride=5, seed=3)
    text, label = "some text to look at, twice", 1
    loss, g = net.gradients(text, label)
    rng = np.random.default_rng(0)
    raw = text.encode()
    for _ in range(20):
        j, f = int(rng.integers(3)), int(rng.integers(2))
        b = raw[int(rng.integers(len(raw)))]
        before = net.tables[j, b, f]
        net.tables[j, b, f] = before + 1e-3
        up = net.gradients(text, label)[0]
        net.tables[j, b, f] = before - 1e-3
        down = net.gradients(text, label)[0]
        net.tables[j, b, f] = before
        assert abs((up - down) / 2e-3 - g["tables"][j, b, f]) < 2e-2


def test_held_out_accuracy_and_no_leak(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = Q.quality_scores(docs, labels)
    rows = out.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.9 * len(held)
    # labels of held out rows have no influence
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) quality")
    other = {r.doc_id: r.score for r in Q.quality_scores(docs, flipped).collect()}
    assert all(other[r.doc_id] == r.score for r in rows)


def test_odd_input(edge, empty, spark):
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    assert Q.quality_scores(empty, none).count() == 0
    assert {r.score for r in Q.quality_scores(edge, none).collect()} == {0.5}
    labels = edge.where("doc_id is not null").selectExpr("doc_id", "cast(doc_id % 2 as int) quality")
    out = Q.quality_scores(edge, labels, per_class=5).collect()
    assert len(out) == edge.count() and all(0 <= r.score <= 1 for r in out)
