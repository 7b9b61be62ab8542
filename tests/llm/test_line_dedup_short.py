import random

import pytest
from test_line_dedup import dist, trees

from campanula.llm import line_dedup as L


def changed(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(len(text) + 1)
        text = text[:i] + rng.choice(["", "x", "é"]) + text[i + rng.randrange(2):]
    return text


@pytest.mark.parametrize("group_rows", [3, 1024])
def test_short_lines_against_all_pairs(spark, group_rows):
    rng = random.Random(group_rows)
    base = ["".join(rng.choice("abc") for _ in range(rng.choice([10, 11, 13, 20, 28, 31, 32, 33, 34]))) for _ in range(25)]
    lines = sorted({x for x in (changed(rng, rng.choice(base), rng.randrange(4)) for _ in range(400)) if len(x) >= 10})
    lids = L.line_ids(lines)[0].tolist()
    want = set()
    for i, a in enumerate(lines):
        for j in range(i):
            b = lines[j]
            if dist(a, b) <= (2 if min(len(a), len(b)) >= 32 else 1):
                want.add(tuple(sorted((lids[i], lids[j]))))
    df = spark.createDataFrame(list(zip(lids, lines)), "lid long, line string")
    got = {tuple(sorted((r.a, r.b))) for r in L.edit_links(df, 2, 32, group_rows, short_chars=10).collect()}
    assert got <= want and trees(got, lids) == trees(want, lids) and (group_rows == 3 or got == want)
    assert sum(min(len(a), len(b)) < 32 for a in lines for b in lines if a < b and dist(a, b) == 1) > 50


def test_registered_query_takes_short_lines(spark):
    nav, long = "home | about us | contact me", "abcdefgh ijklmnop qrstuvwx yz012"
    assert len(nav) == 28 and len(long) == 32
    rows = [(1, f"{nav}\nfirst document of them all"), (2, nav.replace("act me", "act mi") + "\nanother text than before"), (3, long), (4, long[:-1] + "\nwith more"),
            (5, "ten chars!"), (6, "tem chars!\nand other words")]
    out = {r.doc_id: r.removed for r in L.line_dedup_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: "", 2: "0", 3: "", 4: "0", 5: "", 6: "0"}
