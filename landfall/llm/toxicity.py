"""Toxicity classifier with a counterfactual term: swapping who is meant must not move the score.

Labelled texts that name groups are scored again for each name, with that name swapped in its
sentence for another one of the same kind; the squared change of the score is part of the loss, and
the changed text is learned from with the same label. A neutral mention then carries no
weight of its own.
"""

from __future__ import annotations

import re
import zlib
from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from landfall.llm.base import col, fold, free_name
from landfall.llm.linear import Ftrl, Sparse, dense, labelled_sample, scorer, sigmoid, train

SIZE, TRAIN_ROWS = 1 << 20, 12_000
#: Names of groups, by kind; a name is swapped for the next of its kind.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("she", "he"), ("her", "his"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino", "arab"), ("immigrants", "natives", "refugees", "citizens"),
    ("disabled", "healthy", "blind", "deaf"), ("old", "young"), ("elderly", "teenage"),
    ("femmes", "hommes"), ("frauen", "männer"), ("mujeres", "hombres"),
)
_WORD, _SENTENCE = re.compile(r"\w+"), re.compile(r"[.!?\n]+")


def swaps(identities: tuple[tuple[str, ...], ...] = IDENTITIES) -> dict[str, str]:
    return {a: kind[(i + 1) % len(kind)] for kind in identities for i, a in enumerate(kind)}


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % (SIZE - 1) + 1


def _word_features(word: str) -> tuple[int, ...]:
    """The word, and its beginnings for words that are compounds or inflected."""
    return (_hash(word), *(_hash("^" + word[:k]) for k in (4, 5, 6, 7) if len(word) > k))


class _Known(dict):
    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 100_000:
            self.clear()
        self[word] = f = _word_features(word)
        return f


@cache
def _known() -> _Known:
    return _Known()


def forget_words() -> None:
    _known().clear()


def _of_words(words: set[str]) -> np.ndarray:
    known = _known()
    found = {0}
    for w in words:
        found.update(known[w])
    return np.array(sorted(found), np.int64)


def presence(text: str) -> Sparse:
    """Which words and beginnings occur in the whole text, each with value 1; the bias at 0."""
    at = _of_words(set(_WORD.findall(text.lower())))
    return at, np.ones(len(at))


def with_swaps(text: str, identities: tuple[tuple[str, ...], ...] = IDENTITIES) -> tuple[np.ndarray, list[np.ndarray]]:
    """Features of the text, and of the text with one change each: one group's name swapped in one sentence.

    A name that other sentences hold too stays among the words beside the new one. Sentences in which
    the same name is swapped give the same words, so there is at most one change a name; one that changes
    no word (both names of a kind stand elsewhere) is left out.
    """
    other, sentences = swaps(identities), [set(_WORD.findall(s)) for s in _SENTENCE.split(text.lower())]
    words = set().union(*sentences)
    own, changed = _of_words(words), []
    for name in sorted(words & other.keys()):
        swapped = words | {other[name]}
        if sum(name in s for s in sentences) == 1:
            swapped = swapped - {name}
        if swapped != words:
            changed.append(_of_words(swapped))
    return own, changed


def _pack(made: tuple[np.ndarray, list[np.ndarray]]) -> bytes:
    return b"".join(len(x).to_bytes(4, "little") + x.astype("<i4").tobytes() for x in (made[0], *made[1]))


def _unpack(data: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    found, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        found.append(np.frombuffer(data, "<i4", n, at + 4))
        at += 4 + 4 * n
    return found[0], found[1:]


def fit(rows: list[tuple[tuple[np.ndarray, list[np.ndarray]], int, int]], epochs: int = 4, penalty: float = 1.0) -> Sparse:
    model = Ftrl(SIZE, alpha=0.3, l1=0.5, l2=0.1)
    order = np.random.default_rng(11)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            (own, changed), label, _ = rows[i]
            model.learn((own, np.ones(len(own))), label)
            for swapped in changed if penalty else ():
                model.learn((swapped, np.ones(len(swapped))), label)
                _even(model, own, swapped, penalty)
    return model.model()


def _even(model: Ftrl, own: np.ndarray, swapped: np.ndarray, penalty: float) -> None:
    """One step on penalty * (score(own) - score(swapped))**2 with respect to the weights that differ."""
    p, q = (sigmoid(float(model.weights(x).sum())) for x in (own, swapped))
    here, there = np.setdiff1d(own, swapped), np.setdiff1d(swapped, own)
    at = np.concatenate([here, there])
    if len(at):
        slope = np.concatenate([np.full(len(here), p * (1 - p)), np.full(len(there), -q * (1 - q))])
        # The linear part keeps the pull when both scores are saturated.
        lean = np.concatenate([np.ones(len(here)), -np.ones(len(there))]) * float(model.weights(own).sum() - model.weights(swapped).sum())
        model.update(at, penalty * (2 * (p - q) * slope + 0.3 * lean), model.weights(at))


def learn_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS, penalty: float = 1.0) -> Sparse:
    """Weights from at most ``train_rows`` labelled documents outside fold 0 of 5. No labels: no weights, every score 0.5."""
    sample = labelled_sample(docs, labels, doc_id, text, "toxic", lambda d: fold(d, 5) != 0, train_rows)
    return train(sample, with_swaps, lambda rows: fit(rows, penalty=penalty), _pack, _unpack)


def with_toxicity(df: DataFrame, model: Sparse, text: str = "text") -> tuple[DataFrame, str]:
    """``df`` with one more column, the score of the whole text, however long; its name is returned.

    Null scores as empty, repeated rows score alike, an empty table gives no rows.
    """
    name = free_name(df, "score")
    return df.withColumn(name, scorer(presence, dense(model, SIZE), forget_words)(col(df, text))), name
