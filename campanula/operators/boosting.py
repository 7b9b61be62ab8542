"""Gradient boosting of several parts of one table at once (ML-11).

The fits of a comparison (the training part, every fold) grow together: one pass over
the rows sums counts and targets by (part, node, bin) for the next level of every
part's tree, and these sums merge by addition.  A category is one column of codes, so
a row adds to one cell a category and not to one a dummy; the splits considered are
still those of the dummies.  A row is held as its cells in the joint tables of some
columns each, so counting and walking down a tree are lookups by cell.  The margins
are written every ``KEEP`` rounds; the trees since are added on the way.  Neither trees nor sums depend on the number of rows; the
driver gets one table of sums a task and picks the splits.

The settings are those of a ``GBTClassifier``: variance splits of at most ``maxBins``
bins, leaves at the mean, logistic loss, the first tree unshrunk.  Thresholds of a
number come from its values in a sample of about 10,000 rows of the part.
"""

from __future__ import annotations

import functools
import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE, BLOCK, TASK, BUNDLE, REFRESH, KEEP = 10_000, 50_000, 200_000, 1024, 50, 2


@functools.cache
def _walks(depth: int) -> np.ndarray:
    """The node at ``depth`` (four at most) by the bits "goes right" of all nodes above it."""
    bits = np.arange(2 ** (2 ** depth - 1))
    node = np.zeros(len(bits), np.int64)
    for d in range(depth):
        node = 2 * node + (bits >> (2 ** d - 1 + node) & 1)
    return node


def _groups(depth: int) -> list[tuple[int, int, int]]:
    """(level, first node of the level or group, nodes): the first four levels together, then up to 64 nodes of a level."""
    out = [(0, 0, 2 ** min(depth, 4) - 1)]
    for d in range(4, depth):
        out += [(d, at, min(64, 2 ** d)) for at in range(0, 2 ** d, 64)]
    return out


def _tables(tree: list, widths: Sequence[int], depth: int) -> list[list[tuple[int, np.ndarray]]]:
    """Per group of nodes (bundle, its nodes' bits "goes right" by cell); ``tree`` has
    (column, code, whether a level) or None per node."""
    where = {}
    for b, columns in enumerate(_bundles(widths)):
        size = stride = int(np.prod([widths[c] for c in columns]))
        for c in columns:
            stride //= widths[c]
            where[c] = b, size, stride
    out = []
    for level, at, n in _groups(depth):
        kind, first = (np.uint16 if n <= 16 else np.uint32 if n <= 32 else np.uint64), (2 ** level - 1 if level else 0) + at
        bits = {}
        for i in range(n):
            if tree[first + i] is not None:
                column, code, one = tree[first + i]
                b, size, stride = where[column]
                of = np.arange(size) // stride % widths[column]
                right = (of == code if one else of > code).astype(kind) << kind(i)
                bits[b] = bits[b] | right if b in bits else right
        out.append(sorted(bits.items(), key=lambda x: x[0]))
    return out


def _nodes(cells: Sequence[np.ndarray], tables: list, depth: int) -> np.ndarray:
    """The node of each row at ``depth`` by the rows' cells of each bundle."""
    def bits(group):
        got = None
        for b, table in group:
            got = table.take(cells[b]) if got is None else got | table.take(cells[b])
        return got
    first = bits(tables[0])
    node = np.zeros(len(next(c for c in cells if c is not None)), np.int64) if first is None else _walks(min(depth, 4)).take(first.astype(np.int64))
    level = 4
    for (d, at, n), group in zip(_groups(depth)[1:], tables[1:]):
        if d == level:  # the first group of its level
            parent, node, level = node, 2 * node, d + 1
        got = bits(group)
        if got is not None:
            mine = parent - at
            right = (got >> (mine % n).astype(got.dtype) & got.dtype.type(1)).astype(np.int64)
            node = node + (right if n == 2 ** d else np.where((mine >= 0) & (mine < n), right, 0))
    return node


class _Scorer:
    """The weighted sum of the leaves over trees: a row's numbers are coded once, then a tree is a few lookups."""

    def __init__(self, trees: list[dict]):
        used = sorted({s for t in trees for s in t["slot"] if s >= 0})
        self.slots, column = used, {s: i for i, s in enumerate(used)}
        self.cuts = [np.unique([a for t in trees for x, a in zip(t["slot"], t["above"]) if x == s]) for s in used]
        self.widths = [len(c) + 1 for c in self.cuts]
        self.trees = []
        for t in trees:
            depth = (len(t["slot"]) + 1).bit_length() - 1
            tree = [None if s < 0 else (column[s], int(np.searchsorted(self.cuts[column[s]], a)), False) for s, a in zip(t["slot"], t["above"])]
            self.trees.append((t["weight"], depth, _tables(tree, self.widths, depth), np.array(t["leaf"])))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """``x`` has a row per slot."""
        total = np.zeros(x.shape[1])
        codes = [np.searchsorted(c, x[s]).astype(np.int64) for s, c in zip(self.slots, self.cuts)]  # not <= any: the last code
        cells = [_cell(self.widths, columns, codes) for columns in _bundles(self.widths)] or [np.zeros(x.shape[1], np.int64)]
        for weight, depth, tables, leaf in self.trees:
            total += weight * leaf[_nodes(cells, tables, depth)]
        return total


def _cell(widths: Sequence[int], columns: Sequence[int], codes: Sequence[np.ndarray]) -> np.ndarray:
    """The cell of each row in the table of these columns' codes."""
    at = codes[columns[0]].astype(np.int64)
    for c in columns[1:]:
        at = at * widths[c] + codes[c]
    return at


class BoostedModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees.  Each has its nodes level by level: the slot compared (-1: none, all
    rows go left) and the number above which a row goes right, then the leaves."""

    trees = Param(Params._dummy(), "trees", "fitted trees as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, trees: list[dict] | None = None):
        super().__init__()
        if trees is not None:
            self._set(trees=json.dumps(trees))

    def _none(self, total: Column) -> Column:
        """The probability of class 0 by the sum over the trees."""
        return 1.0 / (1.0 + F.exp(2.0 * total))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = json.loads(self.getOrDefault(self.trees))

        @F.pandas_udf("double")
        def total(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            score = _Scorer(trees)
            for x in batches:
                yield pd.Series(score(np.ascontiguousarray(np.concatenate(x.to_list()).reshape(len(x), -1).T)) if len(x) else [], dtype=float)
        none = self._none(total(vector_to_array("features")))
        return dataset.withColumn("probability", array_to_vector(F.array(none, 1.0 - none)))


def takes(estimator) -> bool:
    """Whether these are settings that ``fit_parts`` grows; others keep their own fit."""
    if not isinstance(estimator, GBTClassifier):
        return False
    plain = {"subsamplingRate": 1.0, "featureSubsetStrategy": "all", "lossType": "logistic", "impurity": "variance", "minInstancesPerNode": 1,
             "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "featuresCol": "features", "labelCol": "label"}
    return (all(estimator.getOrDefault(k) == v for k, v in plain.items()) and estimator.getMaxDepth() > 0 and not estimator.hasDefault("thresholds")
            and not any(estimator.isSet(k) for k in ("weightCol", "validationIndicatorCol", "thresholds", "leafCol")))


def thresholds(values: np.ndarray, most: int, weights: np.ndarray | None = None) -> np.ndarray:
    """At most ``most`` thresholds between the different values: all midpoints, or those nearest to equal shares of the rows (of their weights)."""
    different, at, counts = np.unique(values, return_inverse=True, return_counts=True)
    between = (different[:-1] + different[1:]) / 2.0
    if len(between) <= most:
        return between
    if weights is not None:
        counts = np.bincount(at, weights=weights)
    seen = np.cumsum(counts)
    stride = (len(values) if weights is None else seen[-1]) / (most + 1)
    out, target = [], stride
    for i in range(1, len(different)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out)


def _blocks(rows: DataFrame, part: int, cuts: list[np.ndarray | None], slots: Sequence[int], weight: str | None = None) -> DataFrame:
    """The rows as blocks of (part, cells with a row per bundle of columns, label -1 or 1, weight)."""
    ends = np.cumsum(slots)
    widths = _widths(cuts, slots)
    bundles = _bundles(widths)
    wide = max(int(np.prod([widths[c] for c in columns])) for columns in bundles) > 1 << 16
    kind = np.uint32 if wide else np.uint16

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, labels, weights, held = [], [], [], 0

        def block():
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "cells": [np.concatenate(cells, axis=1).tobytes()],
                                               "label": [np.concatenate(labels).tobytes()],
                                               "weight": [np.concatenate(weights).tobytes() if weight else b""], "wide": [wide]})
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).T
            codes = np.zeros((len(slots), batch.num_rows), np.uint32)
            for i, (end, n) in enumerate(zip(ends, slots)):
                if cuts[i] is not None:
                    codes[i] = np.searchsorted(cuts[i], x[end - 1])
                else:
                    for level in range(n):
                        codes[i][x[end - n + level] > 0.5] = level + 1
            cells.append(np.stack([_cell(widths, columns, codes).astype(kind) for columns in bundles]))
            labels.append(np.where(batch.column(1).to_numpy(zero_copy_only=False) > 0, 1, -1).astype(np.int8))
            if weight:
                weights.append(batch.column(2).to_numpy(zero_copy_only=False))
            held += batch.num_rows
            if held >= BLOCK:
                yield block()
                cells, labels, weights, held = [], [], [], 0
        if held:
            yield block()
    return rows.select(vector_to_array("features").alias("x"), F.col("label").cast("double"), *([F.col(weight).cast("double")] if weight else [])).mapInArrow(
        encode, "part int, cells binary, label binary, weight binary, wide boolean")


def _opened(row) -> tuple:
    label = np.frombuffer(row["label"], np.int8)
    cells = np.frombuffer(row["cells"], np.uint32 if row["wide"] else np.uint16).reshape(-1, len(label))
    return row["part"], cells, label, np.zeros(len(label))


def _long(cells: np.ndarray) -> list[np.ndarray]:
    return [c.astype(np.int64) for c in cells]  # lookups and counts take no other kind without a copy


def _grown(blocks: RDD, forest: dict[int, list], widths: dict[int, list[int]], depth: int) -> RDD:
    """The blocks with what these trees add to the margins."""
    def add(mine):
        trees = {p: [(weight, _tables(tree, widths[p], depth), leaf) for weight, tree, leaf in f] for p, f in forest.items()}
        for part, cells, label, margin in mine:
            at = _long(cells)
            for weight, tables, leaf in trees[part]:
                margin = margin + weight * leaf[_nodes(at, tables, depth)]
            yield part, cells, label, margin
    return blocks.mapPartitions(add)


def _widths(cuts: list[np.ndarray | None], slots: Sequence[int]) -> list[int]:
    return [n + 1 if c is None else len(c) + 1 for c, n in zip(cuts, slots)]


def _bundles(widths: Sequence[int]) -> list[list[int]]:
    """Columns counted together, as many as keep the table of their codes small."""
    out, size = [], BUNDLE + 1
    for i, w in enumerate(widths):
        if size * w > BUNDLE:
            out, size = [*out, []], 1
        out[-1].append(i)
        size *= w
    return out


def _by_column(got: np.ndarray, widths: Sequence[int], columns: Sequence[int]) -> dict[int, np.ndarray]:
    """A bundle's table, whose last axis is its cells, summed for each of its columns."""
    shape = [widths[c] for c in columns]
    got = got.reshape(*got.shape[:-1], *shape)
    lead = got.ndim - len(shape)
    return {c: got.sum(axis=tuple(lead + j for j in range(len(shape)) if j != k)) for k, c in enumerate(columns)}


def _level_sums(blocks: RDD, widths: dict[int, list[int]], trees: dict[int, list], depth: int, first: bool,
                counts: dict[int, list[np.ndarray]] | None = None) -> dict[int, list[np.ndarray]]:
    """Per part and column the (count, sum of targets) by node of this depth and code.
    ``counts``: those of an earlier pass at depth 0, where they are always the same."""
    bundles = {p: _bundles(w) for p, w in widths.items()}
    counted = counts is not None

    def sums(mine):
        total = {}
        tables = {p: _tables(tree, widths[p], depth) for p, tree in trees.items()}
        for part, cells, label, margin in mine:
            target = label.astype(float) if first else 4.0 * label / (1.0 + np.exp(2.0 * label * margin))
            at = _long(cells)
            node = _nodes(at, tables[part], depth) if depth else None
            for b, columns in enumerate(bundles[part]):
                size = math.prod(widths[part][c] for c in columns)
                cell, size = at[b] if node is None else node * size + at[b], 2 ** depth * size
                got = np.bincount(cell, weights=target, minlength=size)[None]
                if not counted:
                    got = np.concatenate((np.bincount(cell, minlength=size)[None], got))
                total[part, b] = total[part, b] + got if (part, b) in total else got
        yield {(part, c): t for (part, b), got in total.items()
               for c, t in _by_column(got.reshape(len(got), 2 ** depth, -1), widths[part], bundles[part][b]).items()}

    def merged(a, b):
        return {k: a[k] + b[k] if k in a and k in b else a.get(k, b.get(k)) for k in {**a, **b}}
    got = blocks.mapPartitions(sums).reduce(merged)
    return {p: [np.concatenate((counts[p][c], got[p, c])) if counted else got[p, c] for c in range(len(w))] for p, w in widths.items()}


def _best_split(sums: list[np.ndarray], node: int, numbers: Sequence[bool]) -> tuple:
    """(split or None, mean of the left rows, of the right rows): the largest gain, the first of equals."""
    n, s = sums[0][:, node].sum(axis=1)
    if not n:
        return None, 0.0, 0.0
    best = (0.0, None, s / n, s / n)
    for column, (table, number) in enumerate(zip(sums, numbers)):
        right_n, right_s = table[0, node, 1:], table[1, node, 1:]
        if number:
            right_n, right_s = np.cumsum(right_n[::-1])[::-1], np.cumsum(right_s[::-1])[::-1]
        left_n, left_s = n - right_n, s - right_s
        ok = (right_n > 0) & (left_n > 0)
        if ok.any():
            r, l = np.where(ok, right_n, 1), np.where(ok, left_n, 1)  # noqa: E741
            gain = np.where(ok, (right_s ** 2 / r + left_s ** 2 / l - s ** 2 / n) / n, -1.0)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], (column, i if number else i + 1, not number), left_s[i] / left_n[i], right_s[i] / right_n[i])
    return best[1:]


def _thresholds_of(parts: dict[int, DataFrame], counts: dict[int, int], bins: int, seed: int, slots: Sequence[int],
                   weight: str | None = None) -> dict[int, list[np.ndarray | None]]:
    """Per part and column the thresholds of a number, None for a category."""
    starts = [int(e) - n for e, n in zip(np.cumsum(slots), slots)]
    numbers = [n == 1 for n in slots]  # a single dummy is a number with one threshold
    cuts = {}
    for p, rows in parts.items():
        x = vector_to_array("features")
        picked = rows if counts[p] <= SAMPLE else rows.sample(SAMPLE / counts[p], seed)
        wanted = [F.array(*[x[s] for s, n in zip(starts, numbers) if n]), *([F.col(weight).cast("double")] if weight else [])]
        got = picked.select(*wanted).collect()  # about SAMPLE rows
        seen, weights = np.array([r[0] for r in got]), np.array([r[1] for r in got]) if weight else None
        most = min(bins, counts[p]) - 1
        of = iter(seen.T if len(seen) else [np.empty(0)] * sum(numbers))
        cuts[p] = [thresholds(next(of), most, weights) if n else None for n in numbers]
    return cuts


def _all_slots(rows: DataFrame) -> list[int]:
    return [1] * rows.select(F.size(vector_to_array("features"))).first()[0]


def _plain(tree: list, leaf: np.ndarray, weight: float, cuts: list[np.ndarray | None], slots: Sequence[int]) -> dict:
    """A tree over columns and codes as the models keep it, over slots and numbers."""
    starts = [int(e) - n for e, n in zip(np.cumsum(slots), slots)]
    slot = [-1 if t is None else starts[t[0]] + (t[1] - 1 if t[2] else 0) for t in tree]
    above = [0.0 if t is None else 0.5 if t[2] else float(cuts[t[0]][t[1]]) for t in tree]
    return {"weight": weight, "slot": slot, "above": above, "leaf": leaf.tolist()}


def fit_parts(parts: dict[int, DataFrame], estimator: GBTClassifier, slots: Sequence[int] | None = None) -> dict[int, BoostedModel]:
    """The estimator fitted on each part (``features``, ``label``), all in the same passes.

    ``slots`` has per column of the features its number of slots: 1 for a number, or
    those of a category's dummies, of which a row has at most one set.  Without it every
    slot is a number."""
    depth, step = estimator.getMaxDepth(), estimator.getStepSize()
    counts = {p: rows.count() for p, rows in parts.items()}
    slots = slots or _all_slots(next(iter(parts.values())))
    numbers = [n == 1 for n in slots]
    cuts = _thresholds_of(parts, counts, estimator.getMaxBins(), estimator.getSeed(), slots)
    widths = {p: _widths(cuts[p], slots) for p in parts}

    context = next(iter(parts.values())).sparkSession.sparkContext
    every = functools.reduce(DataFrame.unionAll, [_blocks(rows, p, cuts[p], slots) for p, rows in parts.items()])
    tasks = min(context.defaultParallelism, 1 + sum(counts.values()) // TASK)  # a pass is short, a task costs about 0.1 s whatever its rows
    blocks = every.coalesce(tasks).rdd.map(_opened).persist(StorageLevel.MEMORY_AND_DISK_DESER)  # already bytes: not serialised once more
    state, forest, counted = blocks, {p: [] for p in parts}, None
    try:
        for m in range(estimator.getMaxIter()):
            old, last = state, m % KEEP
            if m and not last:  # the lineage is kept short: now and then from the start, by all trees
                fresh = m % REFRESH < KEEP
                grown = _grown(blocks if fresh else old, {p: f if fresh else f[-KEEP:] for p, f in forest.items()}, widths, depth)
                state = grown.persist(StorageLevel.MEMORY_AND_DISK_DESER)
            now = _grown(state, {p: f[-last:] for p, f in forest.items()}, widths, depth) if last else state
            trees = {p: [None] * (2 ** depth - 1) for p in parts}
            leaves = {p: np.zeros(2 ** depth) for p in parts}
            for d in range(depth):
                sums = _level_sums(now, widths, trees, d, not m, None if d else counted)
                if not d:
                    counted = {p: [t[:1] for t in s] for p, s in sums.items()}
                    if old is not state and old is not blocks:
                        old.unpersist()
                for p in parts:
                    for i in range(2 ** d):
                        split, left, right = _best_split(sums[p], i, numbers)
                        trees[p][2 ** d - 1 + i] = split
                        below = 2 ** (depth - d)  # a node's leaves; rows that are not split go left
                        leaves[p][i * below] = left
                        if split is not None:
                            leaves[p][i * below + below // 2] = right
            for p in parts:
                forest[p].append((step if m else 1.0, trees[p], leaves[p]))
    finally:
        state.unpersist()
        blocks.unpersist()
    return {p: BoostedModel([_plain(tree, leaf, weight, cuts[p], slots) for weight, tree, leaf in forest[p]]) for p in parts}
