"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The benchmark is the query set. Its words and word pairs are indexed in blocks of
items; every document is read once a block against that index. Document frequencies of
the pairs over the whole corpus pick the rarer ones of each item as its seeds, so many that
every passage over the limit holds some of them close together. Such passages are aligned
with the item word by word, so edited copies count by what they still share.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from landfall.llm.base import col, document_key, saved, without

#: Scripts without blanks between words, as ranges of characters: each character is a word of its own.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f"
_WORD = re.compile(f"[^\\W{_UNSPACED}]+|[{_UNSPACED}]")
#: Words of the shortest item that condemns a document; share of an item's alignment score that counts as a leak; words of benchmark text per block.
SHORTEST, LEAST, BLOCK_WORDS = 3, 0.6, 2_000_000
#: Words of a document whose seeds are held at a time.
WINDOW_WORDS = 4096
MATCH, MISMATCH, GAP = 2, -1, -1


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def least_of(n: int, least: float) -> float:
    """The share that an item of n words must reach: one or two words must all be there."""
    return least if n >= SHORTEST else 1.0


def needed(n: int, least: float) -> tuple[int, int]:
    """Words of a gram, and the least number of them that an alignment of share ``least`` with n item words holds.

    m matched words in r unbroken runs score at most 2m - (r - 1). With 2 * least * n or more,
    the m - r matched pairs are at least (2 * least - 1) * n - 1. Where that is no pair, single
    words are the grams: m is at least least * n.
    """
    pairs = math.ceil((2 * least - 1) * n - 1 - 1e-9)
    return (2, pairs) if pairs >= 1 else (1, max(1, math.ceil(least * n - 1e-9)))


def drift(n: int, least: float) -> int:
    """How far the matched words of such an alignment can be shifted against each other: every step costs a gap."""
    return int(2 * (1 - least) * n + 1e-9)


class Seeds(NamedTuple):
    """Of gram g: ``item`` and ``at`` from ``first[g]`` to ``first[g + 1]``; of item k: seeds close together that make a passage."""

    first: np.ndarray
    item: np.ndarray
    at: np.ndarray
    least: np.ndarray


class Index:
    """Words and grams (pairs, or words of short items) of a block of benchmark items; its size is bounded by BLOCK_WORDS."""

    def __init__(self, items: list[tuple[object, str]], least: float) -> None:
        self.ids: dict[str, int] = {}
        self.items: list[tuple[object, np.ndarray]] = []
        self.least = least
        for item, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            if words:
                self.items.append((item, np.array(words, np.int64)))
        self.base = len(self.ids) + 1
        self.needed = [needed(len(w), least_of(len(w), least)) for _, w in self.items]
        self.drift = np.array([drift(len(w), least_of(len(w), least)) for _, w in self.items], np.int64)
        #: No passage is longer than this.
        self.reach = max((len(w) + d for (_, w), d in zip(self.items, self.drift.tolist(), strict=True)), default=0) + 1
        own = [self.codes(w, n) for (_, w), (n, _) in zip(self.items, self.needed, strict=True)]
        self.grams = np.unique(np.concatenate([np.empty(0, np.int64), *own]))
        self.own = [np.searchsorted(self.grams, c) for c in own]

    def codes(self, words: np.ndarray, n: int) -> np.ndarray:
        """A number for each word, or each pair of words, of word numbers; -1 where a word is unknown."""
        if n == 1:
            return np.where(words > 0, words, -1)
        return np.where((words[:-1] > 0) & (words[1:] > 0), words[:-1] * self.base + words[1:], -1)

    def numbers(self, text: str | None) -> np.ndarray:
        get = self.ids.get
        return np.array([get(w, 0) for w in words_of(text)], np.int64)

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the document, and which gram of the index stands there."""
        places, grams = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for n in {n for n, _ in self.needed}:
            code = self.codes(words, n)
            at = np.flatnonzero(code >= 0)
            found = np.minimum(np.searchsorted(self.grams, code[at]), len(self.grams) - 1)
            hit = self.grams[found] == code[at]
            places.append(at[hit])
            grams.append(found[hit])
        return np.concatenate(places), np.concatenate(grams)

    def seeds(self, frequency: dict[int, int]) -> Seeds:
        """The grams of each item without the most frequent ones.

        If every alignment holds t of an item's grams and d of them are left out, it holds t - d
        of the others; half of what t allows is left out.
        """
        places, least = [], []
        for k, (grams, (_, t)) in enumerate(zip(self.own, self.needed, strict=True)):
            spare = (t - 1) // 2
            counts = np.array([frequency.get(g, 0) for g in grams.tolist()])
            at = np.argsort(counts, kind="stable")[: len(grams) - spare]
            places.append(np.stack([grams[at], np.full(len(at), k), at]))
            least.append(t - spare)
        gram, item, at = np.concatenate([np.empty((3, 0), np.int64), *places], axis=1)
        order = np.argsort(gram, kind="stable")
        first = np.searchsorted(gram[order], np.arange(len(self.grams) + 1))
        return Seeds(first, item[order], at[order], np.array(least, np.int64))

    def passages(self, words: np.ndarray, seeds: Seeds, window: int = WINDOW_WORDS) -> dict[int, list[int]]:
        """Of each item that can align: where it would begin, by the seeds that stand close enough together.

        The document is read in windows that overlap by the longest passage, so every passage lies whole in
        one of them, and what is held at a time does not grow with the document.
        """
        place, gram = self.hits(words)
        order = np.argsort(place, kind="stable")
        place, gram = place[order], gram[order]
        starts: dict[int, list[int]] = defaultdict(list)
        window = max(window, 2 * self.reach)
        for a in range(0, max(1, len(words) - self.reach), window - self.reach):
            x, y = np.searchsorted(place, [a, a + window])
            for k, at in zip(*self._close(place[x:y], gram[x:y], seeds), strict=True):
                starts[k].append(at)
        return starts

    def _close(self, place: np.ndarray, gram: np.ndarray, seeds: Seeds) -> tuple[list[int], list[int]]:
        """Items and where they would begin, if enough of their seeds follow within their drift."""
        many = seeds.first[gram + 1] - seeds.first[gram]
        total = int(many.sum())
        if not total:
            return [], []
        entry = np.repeat(seeds.first[gram] - np.cumsum(many) + many, many) + np.arange(total)
        item, begin = seeds.item[entry], np.repeat(place, many) - seeds.at[entry]
        low = int(begin.min())
        width = int(begin.max()) - low + int(self.drift.max(initial=0)) + 1  # keeps the keys of two items apart
        key = np.sort(item * width + begin - low)
        item, begin = key // width, key % width + low
        close = np.searchsorted(key, key + self.drift[item], "right") - np.arange(total) >= seeds.least[item]
        return item[close].tolist(), begin[close].tolist()


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score of an item in a passage, and the passage position where it ends."""
    best, end = 0, 0
    steps = np.arange(len(passage) + 1) * GAP
    row = np.zeros(len(passage) + 1, np.int64)
    for word in item:
        fresh = np.zeros_like(row)
        fresh[1:] = np.maximum(0, np.maximum(row[:-1] + np.where(passage == word, MATCH, MISMATCH), row[1:] + GAP))
        # Gaps along the passage: a running maximum, with the cost of every step taken out first.
        row = np.maximum(0, np.maximum.accumulate(fresh - steps) + steps)
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def best_alignment(item: np.ndarray, document: np.ndarray, starts: list[int], least: float) -> tuple[float, int]:
    """Best share of the item's full score near any of the ``starts`` (where the item would begin), and the end there.

    Right where that is ``least`` or more; else it may be less.
    """
    slack = drift(len(item), least)
    best, end, done = 0.0, 0, -1
    runs: list[list[int]] = []
    for s in sorted(set(starts)):
        a, b = max(0, s - slack), min(len(document), s + len(item) + slack)
        if runs and a <= runs[-1][1] and b - runs[-1][0] <= 8 * len(item):
            runs[-1][1] = max(b, runs[-1][1])
        else:
            runs.append([a, b])
    for a, b in runs:
        if np.isin(item, document[a:b]).sum() < least * len(item) - 1e-9:  # too few words to match
            continue
        score, stop = align(item, document[a:b])
        share = score / (MATCH * len(item))
        if share > best:
            best, end = share, a + stop
    return best, end


def blocks_of(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple[object, str]]]:
    """The benchmark in blocks of at most ``block_words`` words (an item alone may have more), one at a time."""
    rows = benchmark.select(col(benchmark, item_id).alias("i"), col(benchmark, text).alias("t")).dropna()
    block, words = [], 0
    for r in rows.orderBy("i", "t").toLocalIterator():
        n = len(words_of(r.t))
        if block and words + n > block_words:
            yield block
            block, words = [], 0
        block.append((r.i, r.t))
        words += n
    if block:
        yield block


def _leaks_of_block(rows: DataFrame, kind: str, item_kind: pa.DataType, schema: str, index: Index, least: float) -> DataFrame:
    """The leaks of one block, written before the next block is made: its index and seeds are gone from all machines then."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(index)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for batch in batches:
            at, numbers, grams = [], [], []
            for i, t in enumerate(batch.column(2)):
                words = ix.numbers(t.as_py())
                _, found = ix.hits(words)
                if len(found):
                    at.append(i)
                    numbers.append(words.astype("<i4").tobytes())
                    grams.append(np.unique(found))
            few = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [few.column(0), few.column(1), pa.array(numbers, pa.binary()), pa.array(grams, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "words", "grams"],
            )

    met = saved(rows.mapInArrow(meet, f"doc_id {kind}, text_key long, words binary, grams array<long>"), "seed-hits")
    counts = met.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("n"))
    frequency = {r.g: r.n for r in counts.collect()}  # at most one row for each n-gram of the block
    seeds = spark.sparkContext.broadcast(index.seeds(frequency))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, chosen = shared.value, seeds.value
        for batch in batches:
            found = []
            for i, data in enumerate(batch.column(2)):
                words = np.frombuffer(data.as_py(), "<i4").astype(np.int64)
                for k, begins in ix.passages(words, chosen).items():
                    item, own = ix.items[k]
                    wanted = least_of(len(own), least)
                    share, end = best_alignment(own, words, begins, wanted)
                    if share >= wanted:
                        found.append((i, item, share, end))
            few = batch.take(pa.array([f[0] for f in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [few.column(0), few.column(1), *(pa.array([f[j] for f in found], k) for j, k in ((1, item_kind), (2, pa.float64()), (3, pa.int64())))],
                names=["doc_id", "text_key", "item_id", "score", "end_word"],
            )

    found = saved(met.select("doc_id", "text_key", "words").mapInArrow(judge, schema), "block-leaks")
    shared.destroy()
    seeds.destroy()
    return found


def leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", least: float = LEAST, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, text_key, item_id, score, end_word) of every document and item that align.

    Words are runs of letters, digits and underscores, in lower case. score is the best
    local alignment (match 2, mismatch and gap -1) over the score of the whole item, at
    least ``least``; end_word is the word position after it. Of items with one or two words all
    must be there. In scripts without blanks every character is a word. Null texts and null item ids take
    no part; null document texts have no words. Item ids may be of any type. Documents with repeated ids get
    a row each, very long ones are aligned near their seeds only. No documents or no items, no rows.
    """
    kind, items = docs.schema[doc_id].dataType.simpleString(), benchmark.schema[item_id].dataType
    rows = docs.select(*document_key(col(docs, doc_id), col(docs, text)), col(docs, text).alias("text"))
    schema = f"doc_id {kind}, text_key long, item_id {items.simpleString()}, score double, end_word long"
    blocks = blocks_of(benchmark, item_id, item_text, block_words)
    found = [_leaks_of_block(rows, kind, to_arrow_type(items), schema, Index(b, least), least) for b in blocks]
    none = docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found, none)


def clean_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item of three words or more, with its columns.

    An item of one or two words stands in many clean documents; leaks() reports it, but it condemns none.
    """
    size = F.udf(lambda t: len(words_of(t)), "int")  # the benchmark alone
    long_ones = benchmark.filter(size(col(benchmark, "text")) >= SHORTEST)
    gone = saved(leaks(docs, long_ones, doc_id, text, least=least).select("doc_id", "text_key").distinct(), "leaks")
    return without(docs, gone, doc_id, text)
