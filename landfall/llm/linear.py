"""Sparse logistic models on hashed features: labelled sample, follow-the-regularised-leader training, scoring.

The sample is bounded by ``rows`` labelled documents, the least by the hash of their id;
features are made in parallel, one task learns from them, and only the weights that are
not zero come back. Scoring is a sparse dot product per document inside Arrow tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.base import col, remember

#: Sparse features: sorted indexes below the model's size, and their values.
Sparse = tuple[np.ndarray, np.ndarray]


@dataclass
class Ftrl:
    """Per-coordinate follow-the-regularised-leader with L1 and L2 terms; coordinate 0 is the bias."""

    size: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.1
    l2: float = 0.1
    z: np.ndarray = field(init=False)
    n: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.z, self.n = np.zeros(self.size), np.zeros(self.size)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, strength = self.z[at], np.full(len(at), self.l1)
        strength[at == 0] = 0.0  # the bias is free
        step = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= strength, 0.0, (np.sign(z) * strength - z) / step)

    def update(self, at: np.ndarray, gradient: np.ndarray, weights: np.ndarray) -> None:
        squared = gradient * gradient
        rate = (np.sqrt(self.n[at] + squared) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += gradient - rate * weights
        self.n[at] += squared

    def learn(self, x: Sparse, label: float) -> None:
        at, value = x[0], x[1].astype(np.float64)
        w = self.weights(at)
        self.update(at, (sigmoid(float(w @ value)) - label) * value, w)

    def model(self) -> Sparse:
        w = self.weights(np.arange(self.size))
        at = np.flatnonzero(w)
        return at, w[at]


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-max(-35.0, min(35.0, x)))))


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, wanted: Callable[[Column], Column], rows: int) -> DataFrame:
    """(doc_id, label, text) of at most ``rows`` labelled documents whose id passes ``wanted``.

    The choice goes by the hash of the id, so it is the same at every run. Rows with a null
    id, label or text teach nothing; an id with more than one row gives its least text,
    an id with more than one label its greatest.
    """
    known = labels.select(col(labels, doc_id).alias("doc_id"), col(labels, label).cast("int").alias("label")).dropna()
    known = known.filter(wanted(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(col(docs, doc_id).alias("doc_id"), col(docs, text).alias("text")).dropna()
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text"))


def train(sample: DataFrame, features: Callable[[str], object], learn: Callable[[list], Sparse], pack: Callable[[object], bytes], unpack: Callable[[bytes], object]) -> Sparse:
    """Features of the sample in parallel, one task that learns; the weights that aren't zero, sorted.

    An empty sample gives no weights.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [pack(features(t.as_py())) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=["doc_id", "label", "made"])

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted((int(d), int(y), m) for f in frames for d, y, m in zip(f.doc_id, f.label, f.made, strict=True))
        if rows:
            at, w = learn([(unpack(m), y, d) for d, y, m in rows])
            yield pd.DataFrame({"at": at.astype(np.int64), "w": w})

    made = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text").mapInArrow(extract, "doc_id long, label int, made binary")
    found = made.repartition(1).mapInPandas(fit, "at long, w double").toPandas().sort_values("at")
    return found["at"].to_numpy(np.int64), found["w"].to_numpy(np.float64)


def pack_sparse(x: Sparse) -> bytes:
    return len(x[0]).to_bytes(4, "little") + x[0].astype("<i4").tobytes() + x[1].astype("<f4").tobytes()


def unpack_sparse(data: bytes) -> Sparse:
    """Views of the data, which cost nothing beside it."""
    n = int.from_bytes(data[:4], "little")
    return np.frombuffer(data, "<i4", n, 4), np.frombuffer(data, "<f4", n, 4 + 4 * n)


def dense(model: Sparse, size: int) -> np.ndarray:
    w = np.zeros(size, np.float32)
    w[model[0]] = model[1]
    return w


def scorer(features: Callable[[str], Sparse], weights: np.ndarray, forget: Callable[[], None]) -> Callable[[Column], Column]:
    """A column function: text to score between 0 and 1; null scores as the empty text. ``forget`` drops what ``features`` remembers."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        remember(features.__qualname__, forget)
        for texts in batches:
            out = np.empty(len(texts))
            for i, t in enumerate(texts):
                at, value = features(t or "")
                out[i] = sigmoid(float(weights[at] @ value))
            yield pd.Series(out)

    return score
