"""K-means with a scan shared by all models (ML-04, ML-05, ML-06).

All restarts of all cluster counts move together: one iteration is one pass over
the rows, in which a task assigns its rows to the centres of every model that has
not settled and sums them up by (model, cluster).  These sums merge by addition;
the driver gets models x clusters vectors and moves the centres.  The first pass
after the last move also gives the inertia, and one more the silhouette of the
chosen models.

Starting centres come from k-means++ on a sample: the ``sample`` rows with the
smallest hash of the key, the same whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campanula.operators.gram import md5_unit
from campanula.session import materialize


@dataclass
class Model:
    """Fitted centres (k x d) and the sum of squared distances to them."""
    centres: np.ndarray
    inertia: float
    iterations: int

    @property
    def k(self) -> int:
        return len(self.centres)

    def assign(self, features: Column) -> Column:
        """The nearest centre of a vector column (the first of equally near ones), in built-in functions."""
        x = vector_to_array(features)
        distances = F.array(*[F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)),
                                          F.lit(0.0), lambda s, v: s + v) for c in self.centres])
        return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")

    def transform(self, rows: DataFrame, out: str = "prediction", features: str = "features") -> DataFrame:
        return rows.withColumn(out, self.assign(F.col(features)))


def _points(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(0)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] - 2.0 * x @ centres.T + (centres * centres).sum(1)[None, :]
    return np.maximum(d, 0.0)


_SUMS = T.StructType([T.StructField("model", T.IntegerType()), T.StructField("cluster", T.IntegerType()), T.StructField("at", T.IntegerType()),
                      T.StructField("v", T.DoubleType())])


def _pass(points: DataFrame, models: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per model the sums by cluster: rows, squared distances, squared norms, then the coordinates."""
    stacked, ends = np.concatenate(list(models.values())), np.cumsum([len(c) for c in models.values()])
    spans = list(zip(ends - [len(c) for c in models.values()], ends))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(stacked), stacked.shape[1] + 3))
        for batch in batches:
            points_ = _points(batch) if batch.num_rows else ()
            for at in range(0, len(points_), 1000):  # the distances to all centres stay in the cache
                x = points_[at:at + 1000]
                d = _distances(x, stacked)
                hot = np.zeros_like(d)
                row = np.arange(len(x))
                for a, b in spans:
                    hot[row, a + d[:, a:b].argmin(1)] = 1.0
                total[:, 1] += np.einsum("ij,ij->j", hot, d)
                total[:, [0, *range(2, total.shape[1])]] += hot.T @ np.column_stack((np.ones(len(x)), (x * x).sum(1), x))
        for m, (a, b) in zip(models, spans):
            i, j = np.nonzero(total[a:b])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), m), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array(total[a:b][i, j])], names=_SUMS.names)

    out = {m: np.zeros((len(c), c.shape[1] + 3)) for m, c in models.items()}
    for r in points.mapInArrow(sums, _SUMS).groupBy("model", "cluster", "at").agg(F.sum("v").alias("v")).collect():
        out[r.model][r.cluster, r.at] = r.v  # models x clusters x dimensions numbers
    return out


def _start(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ on the sample; fewer different points than k give repeated centres."""
    centres = [sample[rng.integers(len(sample))]]
    while len(centres) < k:
        d = _distances(sample, np.array(centres)).min(1)
        p = d / d.sum() if d.sum() > 0 else np.full(len(sample), 1.0 / len(sample))
        centres.append(sample[rng.choice(len(sample), p=p)])
    return np.array(centres)


def fit(rows: DataFrame, ks: Sequence[int], key: str, restarts: int = 10, seed: int = 42, most: int = 100, tolerance: float = 1e-8,
        sample: int = 2000, features: str = "features") -> dict[int, Model]:
    """For each k the best of ``restarts`` models (least inertia, the first of equals).

    ``rows`` is read once an iteration, so give a written table.  A cluster that
    loses all its rows keeps its centre."""
    points = rows.select(vector_to_array(features).alias("x"))
    first = (rows.select(vector_to_array(features).alias("x"), md5_unit(F.col(key), seed).alias("u"), F.col(key).cast("string").alias("k"))
             .orderBy(F.md5(F.concat("k", F.lit(f":{seed}")).cast("binary")), "k").limit(sample).collect())
    if not first:
        return {}
    start = np.array([r.x for r in first], float)
    centres = {(k, r): _start(start, k, np.random.default_rng([seed, k, r])) for k in ks for r in range(restarts)}
    names = {m: i for i, m in enumerate(centres)}
    inertia: dict[tuple[int, int], float] = {}
    steps = dict.fromkeys(centres, 0)
    moving = set(centres)
    scale = max(float(start.var(axis=0).sum()), 1e-300)
    while moving:
        sums = _pass(points, {names[m]: centres[m] for m in moving})
        for m in sorted(moving):
            s = sums[names[m]]
            inertia[m] = float(s[:, 1].sum())
            new = np.where(s[:, :1] > 0, np.divide(s[:, 3:], s[:, :1], out=np.zeros_like(centres[m]), where=s[:, :1] > 0), centres[m])
            moved = float(((new - centres[m]) ** 2).sum())
            if moved <= tolerance * scale or steps[m] >= most:
                moving.discard(m)  # the inertia is that of the centres as they are
            else:
                centres[m] = new
                steps[m] += 1
    best = {k: min((m for m in centres if m[0] == k), key=lambda m: (inertia[m], m[1])) for k in ks}
    return {k: Model(centres[m], inertia[m], steps[m]) for k, m in best.items()}


def silhouettes(rows: DataFrame, models: dict[int, Model], features: str = "features") -> dict[int, float | None]:
    """ML-06: mean silhouette by squared Euclidean distance of each model, from two
    passes for all: mean distances to clusters follow from their sums."""
    points = rows.select(vector_to_array(features).alias("x"))
    sums = _pass(points, {k: m.centres for k, m in models.items()})
    centres = {k: m.centres for k, m in models.items()}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(centres, 0.0)
        rows_seen = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _points(batch)
            rows_seen += len(x)
            norms = (x * x).sum(1)[:, None]
            at = np.arange(len(x))
            for k, c in centres.items():
                s = sums[k]
                n = s[:, 0]
                live = n > 0
                near = _distances(x, c).argmin(1)
                mean = np.where(live, norms + (s[:, 2] - 2.0 * x @ s[:, 3:].T) / np.maximum(n, 1), np.inf)
                size = n[near]
                own = mean[at, near] * size / np.maximum(size - 1, 1)
                mean[at, near] = np.inf
                other = mean.min(1)
                value = np.where((size > 1) & np.isfinite(other), (other - own) / np.maximum(np.maximum(own, other), 1e-300), 0.0)
                total[k] += float(value.sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.float64()),
                                          pa.array([rows_seen] * len(total), pa.int64())], names=["k", "s", "n"])
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("s", T.DoubleType()), T.StructField("n", T.LongType())])
    got = points.mapInArrow(score, schema).groupBy("k").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    out: dict[int, float | None] = dict.fromkeys(models)
    for r in got:
        if r.n and (sums[r.k][:, 0] > 0).sum() > 1:
            out[r.k] = r.s / r.n
    return out


def sweep(rows: DataFrame, ks: Sequence[int], key: str, restarts: int = 10, seed: int = 42) -> tuple[dict[int, Model], DataFrame]:
    """Models and their table (k, inertia, silhouette) for all k."""
    rows = materialize(rows)
    models = fit(rows, ks, key, restarts, seed)
    scores = silhouettes(rows, models) if models else {}
    table = [(k, m.inertia, scores[k]) for k, m in models.items()]
    return models, rows.sparkSession.createDataFrame(table, "k int, inertia double, silhouette double")
