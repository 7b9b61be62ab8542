"""Toxicity by Levenshtein automata, a lexicon trie and context windows.

*Lexicon.*  Terms, and stems that stand for many words with the same beginning,
are learned from labelled documents: what occurs in many toxic ones and in
hardly any other.  They form a trie.

*Misspellings.*  The Levenshtein automata of all terms, intersected with the
trie, are one automaton: a state is a set of (trie node, edits so far).  States
are determinised when they are first met and then remembered, so a word costs
one lookup a character and most words end in the dead state after a few.  Any
letter may be wrong, the first too, and two neighbours that changed places are
one edit; longer terms allow more edits; digits and signs that
stand for letters are folded first.  Words that clean documents use are never
taken for misspellings.

*Context.*  Each hit gets a score from the words around it: quotation marks and
words of reporting speak for a quotation, words of address for abuse.  A
logistic unit combines plain, misspelled, stem and quoted hits, counts and
density; its weights are learned too.

Null texts count as empty; an empty text has no hits and gets the score of that.
Without labels of both classes every score is 0.5.  Repeated rows get equal
scores.  Texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc32_mod, labelled_sample

# --- fixed values: letters that digits and signs stand for, edges, and words of context ---
FOLD = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
EDGES = ".,;:!?\"'`()[]{}<>#$%&*|+=~^/\\_-“”„«»‘’…¡¿"
QUOTES = "\"“”„«»‘’"
REPORTING = frozenset("said says quote quoted quotes word words term called calling wrote writes insult insults slur meaning means".split())
ADDRESS = frozenset("you your yours youre are is such fucking damn du ihr vous tu".split())
# -------------------------------------------------------------------------------------------

PLAIN, MISSPELLED, STEM, MISSPELLED_STEM = range(4)


def allowed_edits(length: int) -> int:
    return 0 if length < 4 else 1 if length < 8 else 2


class TrieAutomaton:
    """Deterministic automaton of all words close to a term of the lexicon.

    A state maps trie nodes to fewest edits.  ``~node`` stands for a swapped
    pair of letters of which the second has been read: the first leads to the node."""

    def __init__(self, terms: dict[str, bool], whole: bool = False) -> None:
        """``terms``: term to whether it is a stem.  ``whole``: edits at any
        letter and swapped neighbours as one edit; otherwise the first letter
        must be right and a swap counts as two edits."""
        self.whole = whole
        self.letter, self.parent = [""], [0]            # edge and node that lead to each node
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, tuple[int, bool]] = {}
        self.most = [0]
        for term, stem in terms.items():
            node, edits = 0, allowed_edits(len(term))
            for c in term:
                self.most[node] = max(self.most[node], edits)
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.parent.append(node)
                    self.children.append({})
                    self.most.append(0)
                    self.letter.append(c)
                node = self.children[node][c]
            self.most[node] = max(self.most[node], edits)
            self.ends[node] = (edits, stem)
        self.letters = frozenset(c for kids in self.children for c in kids)
        self.ids: dict[frozenset, int] = {}
        self.states: list[dict[int, int]] = []          # node to fewest edits
        self.moves: list[dict[str, int]] = []
        self.stems: list[tuple[int, int] | None] = []   # (edits, node) of a stem that is complete in this state
        self.words: list[tuple[int, int] | None] = []   # (edits, node) of a term that is complete
        self.dead = self._state({})
        self.root = self._state({0: 0})
        self.start = [self._state({n: 0}) for n in self.children[0].values()]
        self.first = dict(zip(self.children[0], self.start))

    def _state(self, nodes: dict[int, int]) -> int:
        todo = list(nodes)
        while todo:  # letters of the term that the word leaves out
            n = todo.pop()
            if n < 0:
                continue
            for kid in self.children[n].values():
                e = nodes[n] + 1
                if e <= self.most[kid] and e < nodes.get(kid, 99):
                    nodes[kid] = e
                    todo.append(kid)
        key = frozenset(nodes.items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(nodes)
            self.moves.append({})
            done = sorted((e, n) for n, e in nodes.items() if n in self.ends and e <= self.ends[n][0])
            self.stems.append(next((x for x in done if self.ends[x[1]][1]), None))
            self.words.append(next((x for x in done if not self.ends[x[1]][1]), None))
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        nodes: dict[int, int] = {}
        for n, e in self.states[state].items():
            if n < 0:
                if self.letter[self.parent[~n]] == c:         # the other letter of a swapped pair
                    nodes[~n] = min(nodes.get(~n, 99), e)
                continue
            if e < self.most[n]:                              # a letter too many
                nodes[n] = min(nodes.get(n, 99), e + 1)
            for letter, kid in self.children[n].items():      # the letter, or another in its place
                cost = e + (letter != c)
                if cost <= self.most[kid]:
                    nodes[kid] = min(nodes.get(kid, 99), cost)
                far = self.children[kid].get(c) if self.whole and letter != c else None
                if far is not None and e < self.most[far]:    # the letter after it
                    nodes[~far] = min(nodes.get(~far, 99), e + 1)
        return self._state(nodes)

    def match(self, word: str) -> int | None:
        """PLAIN to MISSPELLED_STEM for the nearest term, None if there is none."""
        state = self.root if self.whole else self.first.get(word[:1])
        if state is None:
            return None
        stem = self.stems[state]
        for c in word if self.whole else word[1:]:
            c = c if c in self.letters else "\0"
            nxt = self.moves[state].get(c)
            if nxt is None:
                nxt = self.moves[state][c] = self._move(state, c)
            state = nxt
            if state == self.dead:
                break
            if self.stems[state] is not None and (stem is None or self.stems[state] < stem):
                stem = self.stems[state]
        word_end = self.words[state]
        if word_end is not None and (stem is None or word_end[0] <= stem[0]):
            return MISSPELLED if word_end[0] else PLAIN
        if stem is not None:
            return MISSPELLED_STEM if stem[0] else STEM
        return None


def folded(surface: str) -> str:
    """A word of a text as it is looked up."""
    w = surface.strip(EDGES).lower()
    return w if w.isalpha() or not any(c.isalpha() for c in w) else w.translate(FOLD)


@dataclass
class Model:
    terms: dict[str, bool]
    clean: frozenset[str]                       # words of clean documents that look like misspellings
    weights: list[float] = field(default_factory=list)
    context: int = 5


class Scorer:
    #: number of remembered words; forgetting them changes the speed alone
    MOST = 500_000

    def __init__(self, model: Model) -> None:
        self.model, self.automaton, self.known = model, TrieAutomaton(model.terms, whole=True), {}
        self.weights = np.array(model.weights)

    def kind(self, surface: str) -> int | None:
        if surface in self.known:
            return self.known[surface]
        w = folded(surface)
        found = self.automaton.match(w) if w else None
        if found in (MISSPELLED, MISSPELLED_STEM) and w in self.model.clean:
            found = None
        if len(self.known) >= self.MOST:
            self.known.clear()
        self.known[surface] = found
        return found

    def context(self, words: list[str], at: int) -> int:
        """Below 0: a quotation; above 0: abuse of someone."""
        lo = max(0, at - self.model.context)
        before, after = words[lo:at], words[at + 1:at + 1 + self.model.context]
        opened = words[at][0] in QUOTES or any(w[0] in QUOTES for w in before)
        closed = words[at].rstrip(".,;:!?")[-1:] in QUOTES or any(w.rstrip(".,;:!?")[-1:] in QUOTES for w in after)
        around = [w.strip(EDGES).lower() for w in (*before, *after)]
        return sum(w in ADDRESS for w in around) - sum(w in REPORTING for w in around) - 2 * (opened and closed)

    def features(self, text: str | None) -> list[float]:
        words = (text or "").split()
        kinds = list(map(self.kind, words))
        n, quoted, worst = [0, 0, 0, 0], 0, 0.0
        if any(k is not None for k in kinds):
            for i, k in enumerate(kinds):
                if k is None:
                    continue
                c = self.context(words, i)
                if c < 0:
                    quoted += 1
                else:
                    n[k] += 1
                    worst = max(worst, 1.0 + min(c, 3))
        hits = sum(n)
        return [*(float(min(x, 3)) for x in n), float(min(quoted, 3)), worst, 20.0 * hits / (hits + len(words) + 20), 1.0]

    def score(self, text: str | None) -> float:
        z = float(np.clip(np.dot(self.features(text), self.weights), -30, 30))
        return float(1 / (1 + np.exp(-z)))


def _without_copies(rows: list[tuple[str, int]], hashes: int = 4) -> list[tuple[str, int]]:
    """The texts that share none of ``hashes`` smallest shingle hashes with an
    earlier one: copies of one document must not vouch for its words."""
    seen: set[tuple[int, int]] = set()
    out = []
    for text, label in rows:
        w = text.split()
        shingles = {" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))}
        mine = {(k, min(xxhash.xxh3_64_intdigest(x, seed=k) for x in shingles)) for k in range(hashes)}
        if not mine & seen:
            out.append((text, label))
        seen |= mine
    return out


def _chance(toxic: int, other: int, share: float) -> float:
    """Probability that of toxic + other occurrences at least so many fall on toxic documents."""
    n = toxic + other
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log(1 - share))
               for k in range(toxic, n + 1))


def learn_terms(rows: list[tuple[str, int]], chance: float = 1e-5, min_forms: int = 5, purity: float = 20.0,
                stem_lengths: tuple[int, ...] = (4, 5, 6, 7)) -> dict[str, bool]:
    """Terms and stems from (text, label): ``purity`` times as often in toxic
    documents as in others, and so often that the odds of it are below ``chance``."""
    docs = {0: 0, 1: 0}
    words = {0: Counter(), 1: Counter()}
    stems = {0: Counter(), 1: Counter()}
    forms: dict[str, set[str]] = {}
    for text, label in _without_copies(rows):
        seen = {w for w in map(folded, set(text.split())) if len(w) >= 4 and w.isalpha()}
        docs[label] += 1
        words[label].update(seen)
        stems[label].update({w[:k] for w in seen for k in stem_lengths if len(w) >= k})
        if label:
            for w in seen:
                for k in stem_lengths:
                    if len(w) >= k:
                        forms.setdefault(w[:k], set()).add(w)
    if not docs[0] or not docs[1]:
        return {}
    share = docs[1] / (docs[0] + docs[1])

    def pure(x: str, counts) -> bool:
        toxic, other = counts[1][x], counts[0][x]
        return toxic * docs[0] >= purity * other * docs[1] and toxic > 1 and _chance(toxic, other, share) <= chance

    out: dict[str, bool] = {}
    for k in stem_lengths:
        for s in sorted(x for x in stems[1] if len(x) == k):
            if any(s[:j] == x[:j] for x in out if out[x] for j in [min(len(x), k)]) or not pure(s, stems):
                continue
            # the longest beginning that nearly all of its documents have
            for j in (j for j in stem_lengths if j > k):
                longer = max({w[:j] for w in forms[s] if len(w) >= j}, key=lambda x: (stems[1][x], x), default=s)
                if stems[1][longer] >= 0.9 * stems[1][s] and len(forms[longer]) >= min_forms:
                    s = longer
            common = max(words[1][w] for w in forms[s])
            if len(forms[s]) >= min_forms and common < 0.5 * stems[1][s]:
                out[s] = True
    return out | {w: False for w in sorted(words[1]) if pure(w, words) and not any(out.get(w[:j]) for j in stem_lengths)}


def learn_lexicon(rows: list[tuple[str, int]]) -> Model:
    model = Model(learn_terms(rows), frozenset())
    automaton = TrieAutomaton(model.terms, whole=True)
    vocabulary = {folded(w) for text, label in rows if not label for w in set(text.split())}
    model.clean = frozenset(w for w in vocabulary if automaton.match(w) in (MISSPELLED, MISSPELLED_STEM))
    return model


def learn(rows: list[tuple[str, int]], log_odds: float, steps: int = 60, ridge: float = 0.001) -> Model:
    """The lexicon of all rows; weights from features that each half of the
    rows gets by the lexicon of the other half."""
    halves = rows[::2], rows[1::2]
    x, y = [], []
    for seen, other in (halves, halves[::-1]):
        scorer = Scorer(learn_lexicon(seen))
        found = [scorer.features(t) for t, _ in other]
        x += found
        y += [float(label) for _, label in other]
        # what the same abuse would look like misspelled; labelled texts hold few misspellings, clean ones look-alikes
        bent = [[0.0, f[PLAIN], 0.0, f[STEM], *f[4:]] for f, (_, label) in zip(found, other) if label and f[PLAIN] + f[STEM] > 0]
        x += bent
        y += [1.0] * len(bent)
    x, y = np.array(x), np.array(y)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * len(y))
    penalty[-1] = 1e-6
    for _ in range(steps):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    w[-1] += log_odds
    model = learn_lexicon(rows)
    model.weights = w.tolist()
    return model


def train(documents: DataFrame, labels: DataFrame, allowed: Column, per_class: int = 2000, label: str = "toxic",
          id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """A model from at most ``per_class`` documents of each label."""
    rows = labelled_sample(documents, labels, label, allowed, per_class, id_col, text_col)
    toxic = sum(y for _, y in rows)
    if not 2 <= toxic <= len(rows) - 2:
        return None
    # both halves get both classes, in an order that doesn't follow the ids
    rows = [r for k in (0, 1) for r in rows if r[1] == k]
    n = labels.where(allowed & F.col(label).isin(0, 1)).agg(F.count(F.lit(1)), F.sum(F.col(label).cast("long"))).first()
    odds = float(np.log(max(n[1], 1) / max(n[0] - n[1], 1)) - np.log(toxic / (len(rows) - toxic)))
    return learn(rows, odds)


def toxicity_score(text: Column, model: Model | None) -> Column:
    """Score of whole texts, 0 to 1."""
    if model is None:
        return F.lit(0.5)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], index=texts.index, dtype="float64")
    return F.pandas_udf(score, T.DoubleType())(text.cast("string"))


def toxicity_scores(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    fold: int = 1, folds: int = 3, cut: float = 0.7, per_class: int = 2000) -> DataFrame:
    """Per document: whether its label was held out, score and verdict."""
    held_out = crc32_mod(id_col, folds) == fold
    model = train(documents, labels, ~held_out, per_class, id_col=id_col, text_col=text_col)
    out = documents.select(F.col(id_col), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                           toxicity_score(F.col(text_col), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))
