"""Random forests of several parts of one table at once (ML-10), for many rows.

A Spark forest keeps an object a row with one count a tree, copies its rows for each
fit and adds a row's features one by one.  Here the rows are the compact blocks of
``boosting``; one pass a level counts all trees of all parts, how often a tree draws a
row comes again from the block's own seed in each pass, and the splits are picked where
the sums of a tree are, so the driver gets one split a node.

The settings are those of a ``RandomForestClassifier`` of two classes: Poisson draws of
every row, a subset of the slots per node, Gini splits of at most ``maxBins`` bins,
subtrees of one predicted class taken together, probabilities averaged over the trees.
Which rows and slots are drawn differs from Spark's, whose draws go by the place of a row.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import Column, DataFrame

from campanula.operators import boosting as BO


class ForestModel(BO.BoostedModel):
    """Fitted trees; a leaf is the probability of class 1, a tree's weight its share."""

    def _none(self, total: Column) -> Column:
        return 1.0 - total


def takes(estimator) -> bool:
    """Whether these are settings that ``fit_parts`` grows; others keep their own fit."""
    if not isinstance(estimator, RandomForestClassifier):
        return False
    plain = {"subsamplingRate": 1.0, "impurity": "gini", "minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0,
             "featuresCol": "features", "labelCol": "label"}
    return (all(estimator.getOrDefault(k) == v for k, v in plain.items()) and estimator.getFeatureSubsetStrategy() in ("auto", "all", "sqrt")
            and estimator.getMaxDepth() > 0 and not any(estimator.isSet(k) for k in ("thresholds", "leafCol")))


@functools.cache
def _poisson() -> np.ndarray:
    """Draws with mean 1 by a number of 16 bits."""
    ends = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(12)])
    return np.searchsorted(ends, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def _draws(n: int, seed: int, tree: int, block: tuple[int, int]) -> np.ndarray:
    """How often a tree draws each row of a block."""
    raw = np.random.SFC64([seed & 0xFFFFFFFF, tree, *block]).random_raw(-(-n // 4)).view(np.uint16)[:n]
    return _poisson().take(raw.astype(np.int64))


def _subset(slots: Sequence[int], most: int, seed: int, tree: int, node: int) -> list[tuple[int, int]]:
    """The (column, level) of the slots among which a node is split; level 0: a number."""
    every = [(c, level) for c, n in enumerate(slots) for level in ([0] if n == 1 else range(1, n + 1))]
    if most == len(every):
        return every
    picked = np.random.default_rng([seed & 0xFFFFFFFF, tree, node]).choice(len(every), most, replace=False)
    return [every[i] for i in sorted(picked)]


def _gini(w: np.ndarray) -> np.ndarray:
    """The impurity of class weights (two rows)."""
    n = w.sum(axis=0)
    return 1.0 - ((w / np.where(n > 0, n, 1.0)) ** 2).sum(axis=0)


def _split(sums: list[np.ndarray], node: int, subset: Sequence[tuple[int, int]]) -> tuple:
    """(split or None, class weights of the node, left, right): the largest gain, the first of equals."""
    whole = sums[subset[0][0]][node].sum(axis=1)
    best = (0.0, None, whole, whole)
    if not (whole > 0).all():  # no row, or one class
        return None, whole, whole, whole
    at = _gini(whole[:, None])[0]
    for column, level in subset:
        w = sums[column][node]  # class, code
        if level:
            right = w[:, level:level + 1]
            left = np.delete(w, level, axis=1).sum(axis=1, keepdims=True)
        else:
            right, left = np.cumsum(w[:, ::-1], axis=1)[:, ::-1][:, 1:], np.cumsum(w, axis=1)[:, :-1]
        l, r = left.sum(axis=0), right.sum(axis=0)  # noqa: E741
        ok = (l > 0) & (r > 0)
        if ok.any():
            gain = np.where(ok, at - (l * _gini(left) + r * _gini(right)) / (l + r), -1.0)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], (column, level or i, level > 0), left[:, i], right[:, i])
    return best[1], whole, best[2], best[3]


def _pruned(tree: list, weights: list[np.ndarray], depth: int) -> tuple[list, np.ndarray]:
    """The tree without splits whose two sides are leaves of one predicted class, and its leaves' probabilities of class 1."""
    tree, inner = list(tree), 2 ** depth - 1
    for i in reversed(range(inner)):
        sides = (2 * i + 1, 2 * i + 2)
        if tree[i] is not None and all(s >= inner or tree[s] is None for s in sides) and len({int(np.argmax(weights[s])) for s in sides}) == 1:
            tree[i] = None
    leaf = np.zeros(2 ** depth)
    for i in range(2 ** depth):
        at = inner + i
        for up in range(depth):  # a row stays left below a node that is not split
            node = (inner + i + 1 >> (depth - up)) - 1
            if tree[node] is None:
                at = node
                break
        leaf[i] = weights[at][1] / max(weights[at].sum(), 1e-300) if weights[at] is not None else 0.0
    return tree, leaf


def fit_parts(parts: dict[int, DataFrame], estimator: RandomForestClassifier, slots: Sequence[int] | None = None) -> dict[int, ForestModel]:
    """The estimator fitted on each part (``features``, ``label`` and its weights), all in
    the same passes; ``slots`` as in ``boosting.fit_parts``."""
    depth, trees, seed, bootstrap = estimator.getMaxDepth(), estimator.getNumTrees(), estimator.getSeed(), estimator.getBootstrap()
    weight = estimator.getWeightCol() if estimator.isSet("weightCol") else None
    counts = {p: rows.count() for p, rows in parts.items()}
    slots = slots or BO._all_slots(next(iter(parts.values())))
    every = sum(slots)
    most = every if estimator.getFeatureSubsetStrategy() == "all" or (trees == 1 and estimator.getFeatureSubsetStrategy() == "auto") else math.ceil(math.sqrt(every))
    cuts = BO._thresholds_of(parts, counts, estimator.getMaxBins(), seed, slots, weight)
    widths = {p: BO._widths(cuts[p], slots) for p in parts}
    bundles = {p: BO._bundles(w) for p, w in widths.items()}

    def opened(index, rows):
        for k, row in enumerate(rows):
            part, cells, label, _ = BO._opened(row)
            yield part, (index, k), cells, label, np.frombuffer(row["weight"]) if weight else None

    tables = functools.reduce(DataFrame.unionAll, [BO._blocks(rows, p, cuts[p], slots, weight) for p, rows in parts.items()])
    context = tables.sparkSession.sparkContext
    blocks = tables.rdd.mapPartitionsWithIndex(opened).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    forest = {(p, t): [None] * (2 ** depth - 1) for p in parts for t in range(trees)}
    weights = {k: [None] * (2 ** (depth + 1) - 1) for k in forest}
    try:
        for d in range(depth):
            first = 2 ** d - 1
            open_ = [k for k in forest if not d or any(s is not None for s in forest[k][(first - 1) // 2:first])]
            if not open_:
                break

            def sums(mine, d=d, first=first, grown=context.broadcast({k: forest[k] for k in open_})):
                held = {}
                for part, block, cells, label, w in mine:
                    held.setdefault(part, []).append((block, cells, label > 0, w))
                for (part, t), tree in grown.value.items():
                    if part not in held:
                        continue
                    sizes = [math.prod(widths[part][c] for c in columns) for columns in bundles[part]]
                    total = [np.zeros(2 ** (d + 1) * size) for size in sizes]
                    paths = BO._tables(tree, widths[part], d)
                    columns = {c for i in range(2 ** d) for c, _ in _subset(slots, most, seed, t, first + i)}
                    counted = [b for b, of in enumerate(bundles[part]) if columns & {*of}]
                    wanted = {*counted, *(b for group in paths for b, _ in group)}
                    for block, cells, one, w in held[part]:
                        drawn = _draws(len(one), seed, t, block) if bootstrap else np.ones(len(one), np.uint8)
                        some = np.flatnonzero(drawn > 0)
                        drawn = drawn.take(some).astype(float) if w is None else drawn.take(some) * w.take(some)
                        at = [c.take(some).astype(np.int64) if b in wanted else None for b, c in enumerate(cells)]
                        node = one.take(some).astype(np.int64)
                        if d:
                            node += 2 * BO._nodes(at, paths, d)
                        for b in counted:
                            total[b] += np.bincount(node * sizes[b] + at[b], weights=drawn, minlength=len(total[b]))
                    flat = {}
                    for b, columns in enumerate(bundles[part]):  # zeros where no node's subset has a column
                        flat |= BO._by_column(total[b].reshape(2 ** d, 2, -1), widths[part], columns)
                    yield (part, t), np.concatenate([flat[c] for c in range(len(widths[part]))], axis=2)

            def picked(item, d=d, first=first):
                (part, t), flat = item
                by = np.split(flat, np.cumsum(widths[part])[:-1], axis=2)
                return (part, t), [_split(by, i, _subset(slots, most, seed, t, first + i)) for i in range(2 ** d)]
            tasks = max(1, min(context.defaultParallelism, len(open_)))
            for k, splits in blocks.mapPartitions(sums).reduceByKey(np.add, tasks).map(picked).collect():  # a split a node
                for i, (split, whole, left, right) in enumerate(splits):
                    at = first + i
                    if d and weights[k][at] is None:
                        continue  # below a node that is not split
                    weights[k][at] = whole if not d else weights[k][at]
                    if split is not None:
                        forest[k][at], weights[k][2 * at + 1], weights[k][2 * at + 2] = split, left, right
    finally:
        blocks.unpersist()
    out = {p: [] for p in parts}
    for p, t in forest:
        if weights[p, t][0] is not None and weights[p, t][0].sum() > 0:  # a tree that drew no row has no vote
            out[p].append(_pruned(forest[p, t], weights[p, t], depth))
    return {p: ForestModel([BO._plain(tree, leaf, 1.0 / len(f), cuts[p], slots) for tree, leaf in f]) for p, f in out.items()}
