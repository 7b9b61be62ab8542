"""Quality rules: statistics of whole texts and a learned decision list.

The statistics are built-in Spark expressions.  The decision list is learned by
sequential covering from labelled statistics: a rule is grown from threshold
conditions one at a time (best information gain), pruned from its end on held
out rows, and kept if it is precise enough there; the rows it covers are set
aside and the next rule is learned.  The result is an ordered list of readable
conjunctions, emitted as one Spark conditional expression.

Words are runs of characters other than space and U+0009 to U+000D.  Null texts
count as empty, with every statistic 0 (shares of nothing are 0).  Every row is
judged on its own, so repeated rows and ties get equal verdicts.  Without
labels of both classes the list is empty and only the base rule rejects.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import smallest_hashes, whole_text

_SPACES = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WINDOW = 8
#: what the decision list may test
FEATURES = ("n_words", "word_chars_mean", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
            "upper_share", "mark_share", "digit_share", "line_words_mean")


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def with_text_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the struct column ``__stats``: the five counts and the shares
    in ``FEATURES``.  Built-in expressions only, no shuffle."""
    text, h = whole_text(text_col), F.col("__h")
    kept = [F.col(f"`{c}`") for c in df.columns]
    out = df.withColumn("__words", F.filter(F.split(text, _SPACES), lambda w: w != ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("__lines", lines).withColumn("__h", F.transform("__words", lambda w: F.xxhash64(w)))
    out = out.withColumn("__n", F.size("__words")).withColumn("__word_chars", F.length(F.array_join("__words", "")))
    out = out.withColumn("__distinct", F.size(F.array_distinct("__h")))
    # a hash of 2, 4 and then 8 words from each position on; the last 7 positions have no whole window
    out = out.withColumn("__h", F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1))))
    out = out.withColumn("__h", F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 2))))
    out = out.withColumn("__h", F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 4))))
    whole = F.greatest(F.col("__n") - (_WINDOW - 1), F.lit(0))
    out = out.withColumn("__h", F.slice(h, F.lit(1), whole))
    # positions of windows that occur twice; only texts that have any are sorted
    pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    out = out.withColumn("__pairs", F.when(F.size(F.array_distinct(h)) < F.size(h), pairs))
    p = F.col("__pairs")
    again = F.filter(p, lambda x, i: (F.get(p, i + 1)["h"] == x["h"]) | ((i > 0) & (F.get(p, F.greatest(i - 1, F.lit(0)))["h"] == x["h"])))
    out = out.withColumn("__at", F.array_sort(F.transform(again, lambda x: x["at"])))
    at = F.col("__at")
    # each window covers 8 words, or as many as lie before the next one
    covered = F.aggregate(F.transform(at, lambda x, i: F.least(F.lit(_WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(_WINDOW)))),
                          F.lit(0), lambda s, x: s + x)
    out = out.withColumn("__repeat", F.coalesce(covered, F.lit(0)))
    n, w = F.col("__n"), F.col("__word_chars")

    def share(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    symbols, dups = _count_of(text, _SYMBOLS), F.size("__lines") - F.size(F.array_distinct("__lines"))
    stats = {
        "n_words": n.cast("long"), "word_chars": w.cast("long"), "n_symbols": symbols.cast("long"), "n_dup_lines": dups.cast("long"),
        "n_repeat_words": F.col("__repeat").cast("long"), "word_chars_mean": share(w, n), "symbol_share": share(symbols, w),
        "dup_line_share": share(dups, F.size("__lines")), "repeat_share": share(F.col("__repeat"), n), "distinct_share": share(F.col("__distinct"), n),
        "upper_share": share(_count_of(text, _UPPER), w), "mark_share": share(_count_of(text, "!?"), w),
        "digit_share": share(_count_of(text, "0123456789"), w), "line_words_mean": share(n, F.size("__lines"))}
    # a filter on the statistics stays above this explode of one element: pushed below, it would copy the
    # whole chain of expressions and evaluate it again for each element of each array
    return out.select(*kept, F.explode(F.array(F.struct(*(c.alias(k) for k, c in stats.items())))).alias("__stats"))


def base_failed(stats: Column, min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    return (stats["n_words"] < min_words) | (100 * stats["n_repeat_words"] > max_repeat_percent * stats["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self, stats: Column) -> Column:
        c = stats[self.feature]
        return c > self.threshold if self.above else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _candidates(rows: list[dict], cuts: int) -> list[Condition]:
    out = []
    for f in FEATURES:
        values = sorted({r[f] for r in rows})
        step = max(1, len(values) // cuts)
        for a, b in zip(values[:-1:step], values[1::step]):
            out += [Condition(f, up, (a + b) / 2) for up in (True, False)]
    return out


def _counts(rows: list[tuple[dict, int]]) -> tuple[int, int]:
    bad = sum(1 for _, label in rows if not label)
    return bad, len(rows) - bad


def _grow(rows: list[tuple[dict, int]], candidates: list[Condition], most: int) -> Rule:
    """Conditions one by one, each with the best information gain for label 0."""
    rule: list[Condition] = []
    while len(rule) < most:
        bad, good = _counts(rows)
        if not good or not bad:
            break
        before, best, gain = math.log2(bad / (bad + good)), None, 1e-9
        by_feature: dict[str, list] = {}
        for c in candidates:
            if c.feature not in by_feature:
                ordered = sorted((r[c.feature], label) for r, label in rows)
                below = [0]
                for _, label in ordered:
                    below.append(below[-1] + (not label))
                by_feature[c.feature] = [[v for v, _ in ordered], below]
            values, below = by_feature[c.feature]
            lo, hi = 0, len(values)
            while lo < hi:  # number of values up to the threshold
                mid = (lo + hi) // 2
                lo, hi = (mid + 1, hi) if values[mid] <= c.threshold else (lo, mid)
            b = below[-1] - below[lo] if c.above else below[lo]
            size = len(values) - lo if c.above else lo
            if b and (g := b * (math.log2(b / size) - before)) > gain:
                best, gain = c, g
        if best is None:
            break
        rule.append(best)
        rows = [(r, label) for r, label in rows if best.holds(r)]
    return tuple(rule)


def _prune(rule: Rule, rows: list[tuple[dict, int]]) -> Rule:
    """The beginning of the rule with the best worth on held out rows."""
    def worth(k: int) -> tuple[float, int]:
        bad, good = _counts([x for x in rows if covers(rule[:k], x[0])])
        return (bad + 1) / (bad + good + 2), -k
    return rule[:max(range(1, len(rule) + 1), key=worth)] if rule else rule


def learn_rules(rows: list[tuple[dict, int]], max_rules: int = 12, max_conditions: int = 4, cuts: int = 64,
                min_precision: float = 0.9, min_covered: int = 5) -> list[Rule]:
    """Ordered rules that reject (label 0).  Every third row is held out for
    pruning and for the precision that a rule must reach."""
    grow, held = [x for i, x in enumerate(rows) if i % 3], rows[::3]
    out: list[Rule] = []
    while len(out) < max_rules:
        rule = _prune(_grow(grow, _candidates([r for r, _ in grow], cuts), max_conditions), held)
        if not rule:
            break
        bad, good = _counts([x for x in [*grow, *held] if covers(rule, x[0])])
        held_bad, held_good = _counts([x for x in held if covers(rule, x[0])])
        if bad < min_covered or bad < min_precision * (bad + good) or held_bad < min_precision * (held_bad + held_good):
            break
        out.append(rule)
        grow = [x for x in grow if not covers(rule, x[0])]
        held = [x for x in held if not covers(rule, x[0])]
    return out


def labelled_stats(documents: DataFrame, labels: DataFrame, per_class: int = 2000, id_col: str = "doc_id",
                   text_col: str = "text", label: str = "quality") -> list[tuple[dict, int]]:
    """Statistics and label of at most ``2 * per_class`` labelled documents,
    those with the smallest hash of their id among those whose document is
    there.  An id on several documents counts once, with its least statistics."""
    lab = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("__id")).agg(F.max(label).alias("__label"), F.min(label).alias("__least"))
           .where(F.col("__label") == F.col("__least")))
    docs = documents.select(F.col(id_col).alias("__id"), F.col(text_col))
    chosen = smallest_hashes(lab.join(docs.select("__id"), "__id", "left_semi"), per_class, "rules")
    got = (with_text_stats(docs.join(F.broadcast(chosen), "__id"), text_col)
           .groupBy("__id", "__label").agg(F.min("__stats").alias("__stats"))
           .select("__id", "__label", "__stats.*").collect())
    got.sort(key=lambda r: (str(r["__id"])[::-1], r["n_words"], r["word_chars"]))  # an order that doesn't follow the ids
    return [({f: r[f] for f in FEATURES}, int(r["__label"])) for r in got]


def rejected(rules: list[Rule], stats: Column) -> Column:
    """Number (from 1) of the first rule that covers a row, else 0: an ordered
    conditional expression."""
    out = None
    for k, rule in enumerate(rules, 1):
        holds = rule[0].column(stats)
        for c in rule[1:]:
            holds = holds & c.column(stats)
        out = F.when(holds, k) if out is None else out.when(holds, k)
    return F.lit(0) if out is None else out.otherwise(0)


def judge(documents: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """``documents`` with ``__stats``, ``__base_failed``, ``__rule`` and ``__kept``."""
    s = F.col("__stats")
    return (with_text_stats(documents, text_col).withColumn("__base_failed", base_failed(s)).withColumn("__rule", rejected(rules, s))
            .withColumn("__kept", ~F.col("__base_failed") & (F.col("__rule") == 0)))


def quality_digest(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: the counts, the base verdict, the rule that rejects, the verdict."""
    out = judge(documents.select(id_col, "text"), learn_rules(labelled_stats(documents, labels)))
    return out.select(F.col(id_col), *(F.col(f"__stats.{c}").alias(c) for c in
                                       ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                      F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"), F.col("__rule").cast("int").alias("rule"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that neither the base rule nor the decision list rejects."""
    out = judge(documents, learn_rules(labelled_stats(documents, labels)))
    return out.where("__kept").select(*[F.col(f"`{c}`") for c in documents.columns])
