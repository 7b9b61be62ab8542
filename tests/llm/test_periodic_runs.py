import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from campanula.llm import periodic_runs as R


def plain_runs(w):
    """All maximal repetitions, by trying every period at every place."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.setdefault((i, j + q), q)  # smallest period first
            i = j
    return sorted((s, e, q) for (s, e), q in found.items())


def texts():
    rng = random.Random(7)
    for n in (0, 1, 11, 12, 13, 30):
        yield [0] * n
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    yield b  # Fibonacci word
    yield [bin(k).count("1") % 2 for k in range(256)]  # Thue-Morse word
    for k in range(250):
        size = rng.choice((1, 2, 3, 40))
        out = []
        for _ in range(rng.randrange(1, 7)):
            piece = [rng.randrange(size) for _ in range(rng.randrange(1, 14))]
            out += piece * rng.choice((1, 1, 2, 3, 5)) + piece[:rng.randrange(len(piece))]
            if rng.random() < 0.4:
                out += [100 + rng.randrange(1000) for _ in range(rng.randrange(9))]
        yield out
    half = [rng.randrange(50) for _ in range(200)]
    yield half * 2 + [7, 7] + half * 3  # long periods, periods of periods


def test_runs_against_all_periods():
    for w in texts():
        assert [tuple(r) for r in R.find_runs(np.array(w, np.int64)).tolist()] == plain_runs(w), w


def test_grammar_writes_the_text():
    """Every symbol expands to equal words at all its places, and all boundaries are covered."""
    w = np.array([k % 17 % 5 for k in range(400)] + [3] * 50, np.int64)
    g = R.Grammar(w)
    assert sorted(set(g.symbol.tolist())) == list(range(len(g.first)))
    for s, p in zip(g.symbol.tolist(), g.place.tolist()):
        assert (w[p:p + g.last[s] - g.first[s]] == w[g.first[s]:g.last[s]]).all()
    mids = sorted((p + g.mid[s] - g.first[s]) for s, p in zip(g.symbol.tolist(), g.place.tolist()))
    assert mids == list(range(1, len(w)))


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words) if n < 4000 else [tuple(r) for r in R.find_runs(R.word_ids([w.encode() for w in words])).tolist()]
    drop = set()
    for s, e, q in runs:
        drop.update(range(s + q, e))
    best = max(runs, key=lambda r: (r[1] - r[0], -r[0], -r[2])) if runs else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{e - s},{q}\n" for s, e, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def test_documents_against_plain(spark, both, edge):
    docs = both.unionByName(edge.where("doc_id is null").select(*both.columns))
    docs = docs.where("length(text) < 12000 or text is null or doc_id > 1000000")
    rows = docs.select("doc_id", "text").collect()
    want = sorted((plain_row(r.doc_id, r.text) for r in rows), key=key)
    got = sorted((tuple(r) for r in R.runs_digest(docs).collect()), key=key)
    assert got == want
    assert sum(r[1] > 0 for r in got) >= 10


def test_very_long_text_and_empty(spark, edge, empty):
    text = " ".join(f"w{k % 30011}" for k in range(200_000))
    df = spark.createDataFrame([(1, text), (2, "again " * 100_000)], "doc_id long, text string")
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period) for r in R.runs_digest(df).collect()}
    assert got == {1: (1, 0, 200_000, 30011), 2: (1, 0, 100_000, 1)}
    assert R.runs_digest(empty).collect() == [] and R.collapse_runs(empty).collect() == []


@pytest.mark.parametrize("text,kept", [(None, None), ("", ""), ("a  b", "a  b"), ("x " + "go on and " * 6 + "y", "x go on and y"),
                                       ("no " * 12, "no"), ("no " * 11, "no " * 11)])
def test_collapse_keeps_columns(spark, text, kept):
    df = spark.createDataFrame([(text, "clash", 3)], "text string, runs string, n int")
    row = R.collapse_runs(df).collect()[0]
    assert (row.text, row.n) == (kept, 3) and len(row.runs) == (kept != text)
