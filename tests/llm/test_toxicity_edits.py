import random

from campanula.llm import toxicity as X

TERMS = {"scum": False, "idiot": False, "worthless": False, "lowei": True, "vequ": True, "pathetic": False}


def distance(a, b):
    """Edits of single letters and swaps of neighbours."""
    rows = [list(range(len(b) + 1))]
    for i, c in enumerate(a, 1):
        row = [i]
        for j, d in enumerate(b, 1):
            row.append(min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (c != d)))
            if i > 1 and j > 1 and c == b[j - 2] and a[i - 2] == d:
                row[-1] = min(row[-1], rows[-2][j - 2] + 1)
        rows.append(row)
    return rows[-1][-1]


def brute(word):
    words, stems = [], []
    for t, stem in TERMS.items():
        d = min((distance(word[:k], t) for k in range(len(word) + 1))) if stem else distance(word, t)
        if d <= X.allowed_edits(len(t)):
            (stems if stem else words).append(d)
    if words and (not stems or min(words) <= min(stems)):
        return X.MISSPELLED if min(words) else X.PLAIN
    return (X.MISSPELLED_STEM if min(stems) else X.STEM) if stems else None


def test_any_letter_and_swapped_letters():
    assert X.allowed_edits(3) == 0 and X.allowed_edits(4) == 1 and X.allowed_edits(7) == 1 and X.allowed_edits(8) == 2
    s = X.Scorer(X.Model(TERMS, frozenset({"slum"}), [0.0] * 8))
    for w in ("ldiot", "xidiot", "diot", "idoit", "diiot", "scmu", "csum", "cum", "owrthlses"):
        assert s.kind(w) == X.MISSPELLED, w
    assert s.kind("slum") is None and s.kind("idiot") == X.PLAIN and s.kind("olweinto") == X.MISSPELLED_STEM


def test_automaton_against_edit_distance_with_swaps():
    rng = random.Random(11)
    a = X.TrieAutomaton(TERMS, whole=True)
    found = set()
    for _ in range(8000):
        w = list(rng.choice(list(TERMS)) + rng.choice(["", "", "abc", "ß"]))
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w) + 1)
            if rng.random() < 0.4:
                w[i:i + 2] = w[i:i + 2][::-1]
            else:
                w[i:i + rng.randrange(2)] = rng.choice(["", rng.choice("abdeilotuwvq")])
        w = "".join(w)
        assert a.match(w) == brute(w), w
        found.add(a.match(w))
    assert len(found) == 5 and a.match("") is None
