"""Quality classifier: a byte-level convolutional network in numpy.

A text is read as UTF-8 bytes, whole, in overlapping chunks: the chunks start
every ``stride`` bytes and are ``width - 1`` bytes longer, so that every window
of ``width`` bytes lies in one of them.  Learned filters run over the byte
embeddings of each window; their rectified answers are max-pooled within a
chunk.  The pooled chunks of a document are combined by their mean and their
maximum, and a logistic unit turns the result into one probability.

Embedding and filters are only ever used together, so the network holds for
every place in the window a table from byte to the filters' answers.  Training
is stochastic gradient descent with Adam on a bounded sample of labelled
documents (``per_class`` of each label, an explicit parameter); gradients pass
the two poolings to the windows that won.

Null texts count as empty.  An empty text has one chunk of padding and gets a
score like any other.  Without labels of both classes every score is 0.5.
Repeated rows get equal scores.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc32_mod, labelled_sample


class ByteNet:
    """The network; ``tables`` has the shape (width, 256, filters)."""

    def __init__(self, width: int = 6, filters: int = 16, stride: int = 512, embedding: int = 8, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.width, self.filters, self.stride = width, filters, stride
        embed = rng.normal(0, 1, (256, embedding))
        kernel = rng.normal(0, 0.5 / np.sqrt(width * embedding), (width, embedding, filters))
        self.tables = np.einsum("be,wef->wbf", embed, kernel).astype(np.float32)
        self.bias = np.zeros(filters, np.float32)
        self.out = rng.normal(0, 0.1, 2 * filters).astype(np.float32)
        self.out_bias = np.float32(0)
        self.pairs: np.ndarray | None = None

    # -- forward --
    def answers(self, data: np.ndarray) -> np.ndarray:
        """Filter answers (windows, filters) for the windows of a run of bytes."""
        n = len(data) - self.width + 1
        if self.pairs is not None:  # two bytes a lookup
            code = data[:-1].astype(np.uint16) << np.uint16(8) | data[1:]
            got = np.take(self.pairs[0], code[:n], axis=0)
            for k in range(1, len(self.pairs)):
                got += np.take(self.pairs[k], code[2 * k:2 * k + n], axis=0)
            return got
        got = np.take(self.tables[0], data[:n], axis=0)
        for j in range(1, self.width):
            got += np.take(self.tables[j], data[j:j + n], axis=0)
        return got

    def chunks(self, text: str | None) -> list[np.ndarray]:
        raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
        raw = np.concatenate([raw, np.zeros(self.width - 1, np.uint8)]) if len(raw) else np.zeros(self.width, np.uint8)
        last = max(1, len(raw) - self.width + 1)
        return [raw[s:min(s + self.stride, last) + self.width - 1] for s in range(0, last, self.stride)]

    def pooled(self, text: str | None) -> np.ndarray:
        return np.maximum(np.stack([self.answers(c).max(axis=0) for c in self.chunks(text)]) + self.bias, 0)

    def score(self, text: str | None) -> float:
        p = self.pooled(text)
        z = float(np.concatenate([p.mean(axis=0), p.max(axis=0)]) @ self.out + self.out_bias)
        return 1 / (1 + np.exp(-z)) if z >= 0 else np.exp(z) / (1 + np.exp(z))

    # -- training --
    def gradients(self, text: str, label: int) -> tuple[float, dict[str, np.ndarray]]:
        chunks, best, arg = self.chunks(text), [], []
        for c in chunks:
            a = self.answers(c)
            arg.append(a.argmax(axis=0))
            best.append(a[arg[-1], np.arange(self.filters)])
        pre = np.stack(best) + self.bias
        p = np.maximum(pre, 0)
        top = p.argmax(axis=0)
        joined = np.concatenate([p.mean(axis=0), p.max(axis=0)])
        z = float(joined @ self.out + self.out_bias)
        prob = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        d = np.float32(prob - label)
        back = d * self.out
        on = np.repeat((back[:self.filters] / len(chunks))[None], len(chunks), axis=0)
        on[top, np.arange(self.filters)] += back[self.filters:]
        on *= pre > 0
        tables = np.zeros_like(self.tables)
        f = np.arange(self.filters)
        for c, where, g in zip(chunks, arg, on):
            for j in range(self.width):
                np.add.at(tables[j], (c[where + j], f), g)
        return -np.log(max(prob if label else 1 - prob, 1e-9)), {"tables": tables, "bias": on.sum(axis=0), "out": d * joined, "out_bias": d}

    def fit(self, rows: list[tuple[str, int]], steps: int = 800, batch: int = 16, rate: float = 0.01, seed: int = 5) -> "ByteNet":
        rng = np.random.default_rng(seed)
        names = ("tables", "bias", "out", "out_bias")
        m = {k: np.zeros_like(getattr(self, k)) for k in names}
        v = {k: np.zeros_like(getattr(self, k)) for k in names}
        order: list[int] = []
        for t in range(1, steps + 1):
            if len(order) < batch:  # the next pass over the sample
                order = [*order, *rng.permutation(len(rows))]
            part, order = order[:batch], order[batch:]
            total = {k: np.zeros_like(getattr(self, k)) for k in names}
            for i in part:
                _, g = self.gradients(*rows[i])
                for k in names:
                    total[k] = total[k] + g[k]
            step = rate * (1 - t / (steps + 1)) + 1e-4
            for k in names:
                g = total[k] / len(part)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                setattr(self, k, (getattr(self, k) - step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32))
        return self

    def shifted(self, log_odds: float) -> "ByteNet":
        """The same network for another share of label 1 than in its sample."""
        self.out_bias = np.float32(self.out_bias + log_odds)
        return self

    def frozen(self) -> "ByteNet":
        """For scoring only: tables of neighbouring bytes are added up beforehand."""
        if self.width % 2 == 0:
            self.pairs = np.stack([(self.tables[j][:, None, :] + self.tables[j + 1][None, :, :]).reshape(1 << 16, -1)
                                   for j in range(0, self.width, 2)])
        return self

    # -- as bytes, for sending to tasks --
    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, tables=self.tables, bias=self.bias, out=self.out, out_bias=self.out_bias, stride=self.stride)
        return out.getvalue()

    @classmethod
    def loads(cls, data: bytes) -> "ByteNet":
        z = np.load(io.BytesIO(data))
        net = cls(width=z["tables"].shape[0], filters=z["tables"].shape[2], stride=int(z["stride"]))
        net.tables, net.bias, net.out, net.out_bias = z["tables"], z["bias"], z["out"], z["out_bias"]
        return net


def train(documents: DataFrame, labels: DataFrame, allowed: Column, per_class: int = 1500, label: str = "quality",
          id_col: str = "doc_id", text_col: str = "text") -> bytes | None:
    """A fitted network, from at most ``per_class`` documents of each label."""
    rows = labelled_sample(documents, labels, label, allowed, per_class, id_col, text_col, max_chars=60_000)
    if len({y for _, y in rows}) < 2:
        return None
    good = sum(y for _, y in rows)
    # the sample is balanced, the labels are not: the output is moved to the share that label 1 has there
    n = labels.where(allowed & F.col(label).isin(0, 1)).agg(F.count(F.lit(1)), F.sum(F.col(label).cast("long"))).first()
    odds = np.log(max(n[1], 1) / max(n[0] - n[1], 1)) - np.log(good / (len(rows) - good))
    return ByteNet().fit(rows).shifted(odds).dumps()


def quality_score(text: Column, model: bytes | None) -> Column:
    """Score of whole texts, 0 to 1."""
    if model is None:
        return F.lit(0.5)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = ByteNet.loads(model).frozen()
        for texts in batches:
            yield pd.Series([float(net.score(t)) for t in texts], index=texts.index, dtype="float64")
    return F.pandas_udf(score, T.DoubleType())(text.cast("string"))


def quality_scores(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   fold: int = 2, folds: int = 4, cut: float = 0.7, per_class: int = 1500) -> DataFrame:
    """Per document: whether its label was held out, score and verdict."""
    held_out = crc32_mod(id_col, folds) == fold
    model = train(documents, labels, ~held_out, per_class, id_col=id_col, text_col=text_col)
    out = documents.select(F.col(id_col), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                           quality_score(F.col(text_col), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))
