import random
import re
from collections import defaultdict

import pytest

from campanula.llm import line_dedup as L


def dist(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row, last = [i], row
        for j, d in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    return row[-1]


def edited(rng, text, edits, letters="abx é"):
    b = list(text)
    for _ in range(edits):
        i = rng.randrange(len(b) + 1)
        b[i:i + rng.randrange(2)] = rng.choice(["", *letters])
    return "".join(b)


def normal(line):
    return re.sub(r"\s+", " ", line.lower()).strip()


def brute(rows, threshold=2, edit_chars=32):
    """Removed line numbers by (id, text), comparing all pairs of lines."""
    at = defaultdict(list)
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            if normal(line):
                at[normal(line)].append((i, t, k))
    lines = sorted(at, key=len)
    parent = {x: x for x in lines}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(lines):
        for b in lines[i + 1:]:
            if len(b) - len(a) > threshold:
                break
            if len(a) >= edit_chars and dist(a, b) <= threshold:
                parent[root(a)] = root(b)
    classes = defaultdict(list)
    for x in lines:
        classes[root(x)] += at[x]
    gone = defaultdict(set)
    for members in classes.values():
        first = min(members, key=lambda m: (m[0], m[2]))
        for m in members:
            if m != first:
                gone[m[:2]].add(m[2])
    return gone


def corpus(rng, n_docs):
    base = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(rng.randrange(3, 14))) for _ in range(25)]
    docs = []
    for d in range(n_docs):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            line = rng.choice(base) if rng.random() < 0.5 else f"{rng.getrandbits(200):x}"
            lines.append(rng.choice([line, line.upper(), f"  {line}\t", edited(rng, line, rng.randrange(4)), "short"]))
        docs.append((d, "\n".join(lines)))
    return docs


@pytest.mark.parametrize("group_rows,broadcast_rows", [(1024, 500_000), (3, 0)])
def test_against_all_pairs(spark, group_rows, broadcast_rows):
    rows = corpus(random.Random(group_rows), 60) + [(1000, None), (1001, ""), (5, "another text\n of the same id that is repeated")]
    rows += [rows[3]]
    want = brute(rows)
    out = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), group_rows=group_rows, broadcast_rows=broadcast_rows)
    originals = defaultdict(list)
    for i, t in rows:
        originals[i].append(t)
    got = out.select("doc_id", "text", "__dedup.*").toDF("doc_id", "raw", "text", "n_lines", "n_removed", "share", "removed").collect()
    assert len(got) == len(rows) and sum(map(len, want.values())) > 40
    for r in got:
        gone = want.get((r.doc_id, r.raw), set())
        assert set(r.removed) == gone and r.n_removed == len(gone), r
        if r.raw is not None:
            assert r.text == "\n".join(x for k, x in enumerate(r.raw.split("\n")) if k not in gone)


def test_edit_links_with_a_hot_segment(spark):
    """Hundreds of lines with equal beginnings: blocks give what the stream gives."""
    rng = random.Random(9)
    lines = sorted({edited(rng, "this line begins alike in all of them and ends " + f"{rng.randrange(40):04d}", rng.randrange(3), "xyz") for _ in range(150)})
    lids = L.line_ids(lines)[0].tolist()
    df = spark.createDataFrame(list(zip(lids, lines)) * 2, "lid long, line string")
    want = {tuple(sorted((lids[i], lids[j]))) for i in range(len(lines)) for j in range(i + 1, len(lines)) if dist(lines[i], lines[j]) <= 2}
    assert {(r.a, r.b) for r in L.edit_links(df, 2, 32, 4096).collect()} == want and len(want) > 50
    # hot keys, with and without heavy ones: links of the right pairs, and all that hangs together
    for sample in (1, 1 << 40):
        L.SAMPLE, before = sample, L.SAMPLE
        try:
            got = {tuple(sorted((r.a, r.b))) for r in L.edit_links(df, 2, 32, 5).collect()}
        finally:
            L.SAMPLE = before
        assert got <= want and trees(got, lids) == trees(want, lids)


def trees(links, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def test_numbered_template_lines(spark):
    """Lines that share a segment and are nearly all alike: one class, without all pairs being written."""
    n = 20_000
    lines = [f"page {k:05d} of a very long document whose pages are all numbered" for k in range(n)]
    lids = L.line_ids(lines)[0].tolist()
    df = spark.createDataFrame(list(zip(lids, lines)), "lid long, line string").repartition(4)
    links = L.materialize(L.edit_links(L.materialize(df)))
    assert len(set(trees([tuple(r) for r in links.collect()], lids).values())) == 1
    assert links.count() < 60 * n


def test_short_lines_are_one_class_with_their_equals(spark):
    rows = [(1, "Home\nAbout us\n\n-"), (2, "home\n  about   US\nother words\n\n-"), (3, "hom\n\n")]
    out = {r.doc_id: r.removed for r in L.line_dedup_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: "", 2: "0,1,4", 3: ""}


def test_within_and_probes_random():
    rng = random.Random(1)
    for _ in range(4000):
        a = "".join(rng.choice("abcé") for _ in range(rng.choice([1, 3, 8, 40, 90])))
        b = edited(rng, a, rng.randrange(5)) or "a"
        k, d = rng.choice([0, 1, 2, 3]), dist(a, b)
        assert L.within(a, b, k) == (d <= k), (a, b, k)
        if d <= 2 and min(len(a), len(b)) >= 3:
            r, s = sorted((a, b), key=len)
            parts = L.segments(len(r), 3)
            assert any(s[p:p + n] == r[parts[i][0]:parts[i][0] + n] for i, p, n in L.probes(len(s), len(r), 2))
            assert L._alike(L.signatures([a]), L.signatures([b]), 2).all()


def test_documents_that_stay(spark, edge, empty):
    line = "a line that is long enough to be compared with others"
    rows = [(1, f"{line}\nown words here"), (2, line), (3, f"{line.upper()}.\nsome more words of its own, enough to stay"), (4, f"{line}\nx y"), (5, None), (6, "")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in L.drop_repeated_lines(df).collect()}
    assert set(out) == {1, 3, 5, 6} and out[3].text == "some more words of its own, enough to stay" and out[3].n_chars == len(out[3].text)
    assert out[1].text == rows[0][1] and out[5].text is None
    kept = L.drop_repeated_lines(edge)
    assert kept.columns == edge.columns and kept.where("doc_id = 900").count() == 2
    assert L.line_dedup_digest(empty).count() == 0 and L.line_dedup_digest(edge).count() == edge.count()
