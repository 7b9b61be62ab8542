import random
import zlib

from campanula.llm import toxicity as X

TERMS = {"scum": False, "idiot": False, "worthless": False, "lowei": True, "vequ": True, "pathetic": False}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row, last = [i], row
        for j, d in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    return row[-1]


def brute(word):
    """Nearest term: the first letter is right, the rest of the word (of some
    beginning of it for a stem) is close enough to the rest of the term."""
    words, stems = [], []
    for t, stem in TERMS.items():
        if not word or word[0] != t[0]:
            continue
        most = X.allowed_edits(len(t))
        d = min(distance(word[1:k], t[1:]) for k in range(1, len(word) + 1)) if stem else distance(word[1:], t[1:])
        if d <= most:
            (stems if stem else words).append(d)
    if words and (not stems or min(words) <= min(stems)):
        return X.MISSPELLED if min(words) else X.PLAIN
    return (X.MISSPELLED_STEM if min(stems) else X.STEM) if stems else None


def test_automaton_against_edit_distance():
    rng = random.Random(7)
    a = X.TrieAutomaton(TERMS)
    words = [*TERMS, "idot", "idiiot", "ldiot", "worthles", "wrthlss", "loweiß", "lowi", "vequnto", "x", ""]
    for _ in range(6000):
        w = list(rng.choice(list(TERMS)) + rng.choice(["", "", "abc", "ß"]))
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w) + 1)
            w[i:i + rng.randrange(2)] = rng.choice(["", rng.choice("abdeilotuwvq")])
        words.append("".join(w))
    found = set()
    for w in words:
        assert a.match(w) == brute(w), w
        found.add(a.match(w))
    assert len(found) == 5


def test_quotation_and_abuse():
    m = X.Model({"idiot": False, "worthless": False}, frozenset({"idio"}), [2.0, 2.0, 2.0, 2.0, 0.0, 2.0, 1.0, -5.0])
    s = X.Scorer(m)
    assert s.score("you are an idiot") > s.score("the idiot left") > 0.3 > s.score('the word "idiot" was quoted') > 0
    assert s.kind("1d10t!!") in (X.PLAIN, X.MISSPELLED) and s.kind("idio") is None and s.kind("###") is None
    assert s.features("") == s.features(None) and s.features("")[:6] == [0.0] * 6


def test_held_out_accuracy_and_no_leak(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = X.toxicity_scores(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held)
    assert not any(r.predicted and not r.toxic for r in held)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - toxic, toxic) toxic")
    other = {r.doc_id: r.score for r in X.toxicity_scores(docs, flipped).collect()}
    assert all(abs(other[r.doc_id] - r.score) < 0.2 for r in rows)  # only the share of label 1 among the others may move it
    assert all(other[r.doc_id] == r.score for r in rows)


def test_odd_input(edge, empty, spark):
    none = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    assert X.toxicity_scores(empty, none).count() == 0
    assert {r.score for r in X.toxicity_scores(edge, none).collect()} == {0.5}
    labels = edge.where("doc_id is not null").selectExpr("doc_id", "cast(doc_id % 2 as int) toxic")
    out = X.toxicity_scores(edge, labels).collect()
    assert len(out) == edge.count() and all(0 <= r.score <= 1 for r in out)
