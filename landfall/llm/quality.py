"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader updates.

Words are runs of letters, runs of digits and single marks; a word that repeats the one
before it counts as one special word, so that filler is seen whatever is repeated.
"""

from __future__ import annotations

import re
import zlib
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.base import fold, free_name, col
from landfall.llm.linear import Ftrl, Sparse, dense, labelled_sample, pack_sparse, scorer, train, unpack_sparse

#: Size of the hashed space, and the most labelled documents that are learned from.
SIZE, TRAIN_ROWS = 1 << 20, 12_000
_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
_AGAIN = 77


class _Ids(dict):
    """Word to hash, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return h


@cache
def _ids() -> _Ids:
    return _Ids()


def forget_words() -> None:
    _ids().clear()


def ngrams(text: str) -> Sparse:
    """Hashed one- and two-word features of the whole text: damped counts of unit length, and the bias at 0."""
    words = np.fromiter(map(_ids().__getitem__, _WORD.findall(text.lower())), np.uint64)
    if len(words):
        words[1:][words[1:] == words[:-1]] = _AGAIN
    pairs = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    both = np.concatenate([words * np.uint64(0x9E3779B1) >> np.uint64(7), pairs >> np.uint64(40)])
    at, count = np.unique(both.astype(np.int64) % (SIZE - 1) + 1, return_counts=True)
    value = 1 + np.log(count)
    value /= max(1e-9, float(np.sqrt(value @ value)))
    return np.concatenate([[0], at]), np.concatenate([[1.0], value])


def fit(rows: list[tuple[Sparse, int, int]], epochs: int = 3) -> Sparse:
    model = Ftrl(SIZE, alpha=2.0, l1=0.05, l2=0.01)
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            model.learn(rows[i][0], rows[i][1])
    return model.model()


def learn_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS) -> Sparse:
    """Weights from at most ``train_rows`` labelled documents outside fold 2 of 4. No labels: no weights, every score 0.5."""
    sample = labelled_sample(docs, labels, doc_id, text, "quality", lambda d: fold(d, 4) != 2, train_rows)
    return train(sample, ngrams, fit, pack_sparse, unpack_sparse)


def with_quality(df: DataFrame, model: Sparse, text: str = "text") -> tuple[DataFrame, str]:
    """``df`` with one more column, the score of the whole text, however long; its name is returned.

    Null scores as empty, repeated rows score alike, an empty table gives no rows.
    """
    name = free_name(df, "score")
    return df.withColumn(name, scorer(ngrams, dense(model, SIZE), forget_words)(col(df, text))), name


def good_documents(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.7) -> DataFrame:
    """The rows of ``df`` that score ``least`` or more, with its columns."""
    scored, name = with_quality(df, learn_quality(df, labels, doc_id, text), text)
    return scored.filter(F.col(name) >= least).drop(name)
