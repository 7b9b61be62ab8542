"""Least squares and logistic regression from Gram sums (ML-14, ML-15, CAU-01).

A model never sees rows on the driver and no iterative solver walks over them
in many passes.  One pass over the rows gives X'X, X'y and y'y; they are sums,
so partial results of tasks merge by addition, and what is left is a solve of
the size of the model.  Logistic regression repeats that pass with the weights
of the current coefficients (iteratively reweighted least squares).

Categories stay sparse: a row adds to the counts of its levels and of its pairs
of levels, and to the level sums of the numbers; no dummy columns are built.
Numbers are shifted by their means first, so sums of squares do not cancel.

The number of columns (numbers and levels) is bounded by ``MAX_COLUMNS``; more
is an error, since the sums have its square as size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_COLUMNS = 1000
UNKNOWN = "Unknown"


def md5_unit(key: Column, seed: int) -> Column:
    """A number in [0, 1), in steps of 1/10000, that the key and the seed decide."""
    h = F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return (h % 10000) / 10000.0


@dataclass
class Design:
    """Columns of a model: numbers, then the kept levels of each category."""
    num: list[str]
    levels: dict[str, list[str]]
    n: int
    shift: np.ndarray  # of [1, numbers, levels, y]: means of numbers and y, else 0
    names: list[str] = field(init=False)

    def __post_init__(self):
        self.names = [*self.num, *(f"{c}_{v}" for c, vs in self.levels.items() for v in vs)]


def frame(df: DataFrame, y: str, num: Sequence[str], cat: Sequence[str] = (), part: Column | None = None) -> DataFrame:
    """The columns of a regression: ``_y``, numbers as double, levels as text (null:
    a level of its own) and the number of the part; rows without y or a number go."""
    cols = [F.col(y).cast("double").alias("_y"), (F.lit(0) if part is None else part).cast("int").alias("_part"),
            *[F.col(c).cast("double").alias(c) for c in num], *[F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c) for c in cat]]
    known = F.lit(True)
    for c in ("_y", *num):
        known = known & F.col(c).isNotNull() & (F.abs(F.col(c)) < float("inf"))  # NaN is above infinity
    return df.select(*cols).filter(known)


def design(rows: DataFrame, num: Sequence[str], cat: Sequence[str] = (), drop_first: bool = True) -> Design:
    """Levels (sorted; without each category's first one if asked: a category with
    one level then has no column) and means, from two small aggregates."""
    levels: dict[str, list[str]] = {c: [] for c in cat}
    if cat:
        seen = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in cat])).alias("s")) \
                   .select("s.*").distinct().limit(MAX_COLUMNS + 1).collect()
        if len(seen) + len(num) > MAX_COLUMNS:
            raise ValueError(f"more than {MAX_COLUMNS} columns")
        for r in sorted(seen):
            levels[r.c].append(r.v)
    if drop_first:
        levels = {c: vs[1:] for c, vs in levels.items()}
    means = rows.agg(F.count(F.lit(1)), *[F.avg(c) for c in ("_y", *num)]).first()
    n = means[0]
    known = [m or 0.0 for m in means[1:]]
    shift = np.array([0.0, *known[1:], *[0.0] * sum(map(len, levels.values())), known[0]])
    return Design(list(num), levels, n, shift)


_SUMS = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
                      T.StructField("v", T.DoubleType())])


def gram(rows: DataFrame, d: Design, coefs: np.ndarray | None = None) -> dict[int, np.ndarray]:
    """Sums of products of the shifted columns [1, x, y], per part.

    With ``coefs`` (of the shifted [1, x]) rows have their logistic weight w = p (1 - p)
    and y is replaced by (y - p) / w, so the last column holds the gradient."""
    p, sizes = len(d.num), [len(v) for v in d.levels.values()]
    starts = [p + 1 + sum(sizes[:k]) for k in range(len(sizes))]
    size = p + sum(sizes) + 2
    num_shift = np.array([*d.shift[1:p + 1], d.shift[-1]])
    num, levels = d.num, d.levels

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        sets = [pa.array(v, pa.string()) for v in levels.values()]
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            part = get("_part").to_numpy(zero_copy_only=False)
            dense = np.empty((batch.num_rows, p + 2))
            dense[:, 0] = 1.0
            for k, c in enumerate([*num, "_y"]):
                dense[:, k + 1] = get(c).to_numpy(zero_copy_only=False) - (num_shift[k] if coefs is None or k < p else 0.0)
            index = [pc.fill_null(pc.index_in(get(c), value_set=s), -1).to_numpy(zero_copy_only=False) for c, s in zip(levels, sets)]
            weight = np.ones(batch.num_rows)
            if coefs is not None:
                eta = dense[:, :-1] @ coefs[:p + 1]
                for k, at in enumerate(index):
                    eta += np.append(coefs[starts[k]:starts[k] + sizes[k]], 0.0)[at]  # -1: a level without a column
                prob = 1.0 / (1.0 + np.exp(-np.clip(eta, -500, 500)))
                weight = np.maximum(prob * (1.0 - prob), 1e-12)
                dense[:, -1] = (dense[:, -1] - prob) / weight
            for q in np.unique(part).tolist():
                rows_q = part == q
                a, w, at = dense[rows_q], weight[rows_q], [i[rows_q] for i in index]
                g = total.setdefault(q, np.zeros((size, size)))
                places = [*range(p + 1), size - 1]
                g[np.ix_(places, places)] += a.T @ (a * w[:, None])
                for k, i in enumerate(at):
                    span = slice(starts[k], starts[k] + sizes[k])
                    for column, place in zip(a.T, places):
                        got = np.bincount(i + 1, column * w, sizes[k] + 1)[1:]
                        g[span, place] += got
                        g[place, span] += got
                    g[range(span.start, span.stop), range(span.start, span.stop)] += np.bincount(i + 1, w, sizes[k] + 1)[1:]
                    for m in range(k):
                        cells = np.bincount((i + 1) * (sizes[m] + 1) + at[m] + 1, w, (sizes[k] + 1) * (sizes[m] + 1))
                        cells = cells.reshape(sizes[k] + 1, sizes[m] + 1)[1:, 1:]
                        other = slice(starts[m], starts[m] + sizes[m])
                        g[span, other] += cells
                        g[other, span] += cells.T
        for q, g in total.items():
            i, j = np.nonzero(np.triu(g))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), q), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array(g[i, j])], names=_SUMS.names)

    out: dict[int, np.ndarray] = {}
    for r in rows.mapInArrow(sums, _SUMS).groupBy("part", "i", "j").agg(F.sum("v").alias("v")).collect():  # at most parts x columns^2
        g = out.setdefault(r.part, np.zeros((size, size)))
        g[r.i, r.j] = g[r.j, r.i] = r.v
    return out


def raw_sums(g: np.ndarray, d: Design) -> np.ndarray:
    """The sums of products without the shift."""
    move = np.eye(len(g))
    move[0] += d.shift
    return move.T @ g @ move


def _scales(g: np.ndarray, ddof: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Means and standard deviations of the (shifted) x columns; a constant column has 0."""
    n = g[0, 0]
    mean = g[0, 1:-1] / n
    var = np.maximum(np.diag(g)[1:-1] - n * mean * mean, 0.0) / max(n - ddof, 1)
    return mean, np.where(var > 1e-12 * np.maximum(mean * mean, 1e-12), np.sqrt(var), 0.0)


def least_squares(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of the shifted [1, x], and of the standardised x; constant
    columns have 0, dependent ones the shortest solution."""
    n = g[0, 0]
    mean, std = _scales(g, ddof=1)
    inverse = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
    y_mean = g[0, -1] / n
    cov = (g[1:-1, 1:-1] - n * np.outer(mean, mean)) * np.outer(inverse, inverse) / max(n - 1, 1)
    cross = (g[1:-1, -1] - n * mean * y_mean) * inverse / max(n - 1, 1)
    standard = np.linalg.lstsq(cov, cross, rcond=1e-10)[0] if len(cross) else cross
    slope = standard * inverse
    return np.concatenate(([y_mean - slope @ mean], slope)), standard


def squared_error(g: np.ndarray, coefs: np.ndarray) -> float:
    """Sum of squared residuals of any rows, from their Gram sums alone."""
    full = np.append(-coefs, 1.0)
    return float(full @ g @ full)


@dataclass
class LogitFit:
    design: Design
    coefs: np.ndarray | None       # of the raw [1, x]; None if there is nothing to fit
    scaled: np.ndarray | None      # of the standardised x (or the raw x, if not standardised)
    std_error: np.ndarray | None
    iterations: int = 0

    def score(self) -> Column:
        """The probability as a row expression, all in built-in functions."""
        if self.coefs is None:
            return F.lit(None).cast("double")
        eta = F.lit(float(self.coefs[0]))
        for c, b in zip(self.design.num, self.coefs[1:]):
            eta = eta + F.col(c).cast("double") * F.lit(float(b))
        at = len(self.design.num) + 1
        for c, vs in self.design.levels.items():
            if vs:
                table = F.create_map(*[F.lit(x) for v, b in zip(vs, self.coefs[at:]) for x in (v, float(b))])
                eta = eta + F.coalesce(F.try_element_at(table, F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))), F.lit(0.0))
            at += len(vs)
        return 1.0 / (1.0 + F.exp(-eta))


def fit_logit(rows: DataFrame, num: Sequence[str], cat: Sequence[str] = (), ridge: float = 1.0, standardise: bool = True,
              drop_first: bool = False, most: int = 50, tolerance: float = 1e-9) -> LogitFit:
    """Logistic regression of ``_y`` (0 or 1) by reweighted Gram sums, one pass a step.

    ``ridge`` is the weight of half the squared coefficients (not of the intercept),
    as in the usual "C = 1 / ridge"; with it all levels of a category can stay.
    Without rows or with one class only there is nothing to fit.
    """
    d = design(rows, num, cat, drop_first)
    ones = d.n * d.shift[-1]
    if not d.n or ones <= 0 or ones >= d.n:
        return LogitFit(d, None, None, None)
    m = len(d.names)
    beta = np.zeros(m + 1)     # of the (standardised) columns
    penalty = ridge * np.append(0.0, np.ones(m))
    move = scale = None
    for step in range(1, most + 1):
        g = gram(rows, d, np.zeros(m + 1) if move is None else move @ beta)[0]
        if move is None:  # p = 1/2 for all rows: the plain sums, four times as large
            mean, std = _scales(4.0 * g)
            if not standardise:
                mean, std = -d.shift[1:-1], (std > 0).astype(float)
            scale = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
            move = np.eye(m + 1)   # [1, scaled x] = [1, shifted x] @ move
            move[0, 1:] = -mean * scale
            move[1:, 1:] = np.diag(scale)
        hessian = move.T @ g[:-1, :-1] @ move + np.diag(penalty)
        gradient = move.T @ g[:-1, -1] - penalty * beta
        delta = np.linalg.lstsq(hessian, gradient, rcond=1e-12)[0]
        beta = beta + delta
        if np.max(np.abs(delta)) < tolerance:
            break
    std_error = np.sqrt(np.maximum(np.diag(np.linalg.pinv(hessian)), 0.0))
    coefs = move @ beta
    coefs[0] -= coefs[1:] @ d.shift[1:-1]
    return LogitFit(d, coefs, beta[1:], std_error[1:], step)
