import random

import numpy as np
import pyarrow as pa

from campanula.llm import line_dedup as L


def test_texts_are_rebuilt_once(spark):
    """The filter on what is left must not call the function a second time, by a second worker."""
    docs = spark.createDataFrame([(1, "some line of text\nother"), (2, "some line of text"), (3, None)], "doc_id long, text string")
    out = L.drop_repeated_lines(docs, short_chars=L.SHORT_CHARS, min_share=0.0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1, plan
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "some line of text\nother"), (3, None)]


def test_texts_are_read_in_slices(monkeypatch):
    monkeypatch.setattr(L, "SLICE", 2)
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(range(5)), pa.array(["A  b\nc", "", "\n", "a b", "x\ny\nz"])], names=["id", "row", "text"])
    out = list(L._occurrences(1, 1)(iter([batch])))
    assert len(out) == 3
    rows = [(r["id"], r["pos"], r["line"]) for b in out for r in b.to_pylist()]
    assert rows == [(0, 0, "a b"), (0, 1, "c"), (3, 0, None), (4, 0, "x"), (4, 1, "y"), (4, 2, "z")]
    left = L._without_lines(pa.array(["a\nb", None, "c\n\nd e", ""]), pa.array([[0], None, [0, 2], []], pa.list_(pa.int32())))
    assert [tuple(r.values()) for r in left.to_pylist()] == [("b", 2, 1, 0.5), (None, 0, 0, 1.0), ("", 3, 2, 0.0), ("", 1, 0, 1.0)]


def test_keys_of_equal_pieces_are_equal():
    """A key stands for the length and the text of its piece, wherever it stands."""
    rng = random.Random(5)
    lines = ["".join(rng.choice("ab é\U0001F600") for _ in range(rng.randrange(10, 70))) for _ in range(2500)]
    lines += [x[1:] + "z" for x in lines[:50]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(lines))), pa.array(lines)], names=["lid", "line"])
    keys: dict[int, list[int]] = {}
    for b in L._make_keys(2, 32, 10)(iter([batch])):
        for r in b.to_pylist():
            keys.setdefault(r["lid"], []).append(r["key"])
    named, steps = {}, 0
    for i, line in enumerate(lines):
        n = len(line)
        edits = {m: L.edits_of(m, 2, 32) for m in range(max(10, n - 2), n + 1)}
        held = [(n << 8 | k, at, at + size) for k, (at, size) in enumerate(L.segments(n, edits[n] + 1))]
        asked = [(m << 8 | k, p, p + size) for m, most in edits.items() if n - m <= most for k, p, size in L.probes(n, m, most)]
        asked = [x for x in asked if x not in held]
        assert len(keys[i]) == len(held) + len(asked)
        for (seed, s, e), key, probe in zip(held + asked, keys[i], [0] * len(held) + [1] * len(asked)):
            assert key & 1 == probe and key >> 1 & 31 == edits[seed >> 8]
            assert named.setdefault((seed, line[s:e]), key >> 1) == key >> 1
            steps += 1
    assert len(set(named.values())) == len(named) < steps
    assert np.array_equal(L._Pieces().hashes(L._codes(["abc", "xabc"]), np.zeros(2, np.uint64), np.array([0, 4]), np.array([3, 7]))[:1],
                          L._Pieces().hashes(L._codes(["xxabc"]), np.zeros(1, np.uint64), np.array([2]), np.array([5])))
