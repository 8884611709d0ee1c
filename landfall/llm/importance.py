"""Importance resampling towards a target text collection, with exact integer weights by bit planes.

A document's features are its runs of one to three words, hashed into buckets. Its bucket
counts are kept as bit planes: plane i has a bit for each bucket whose count has bit i. A
bucket's gain (how much likelier it is in the target than in the corpus) is an integer, kept
as planes of its size, for positive and negative gains. The weight of a document, the sum of
counts times gains, is then a sum over pairs of planes: the bits both have, times a power of two.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.base import col, saved

BUCKETS, LONGEST_RUN = 10_000, 3
#: Words remembered in a task.
KEPT = 150_000
#: A-Z to a-z; ASCII that is neither letter nor digit separates words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class _Words(dict):
    """Word to crc32 of a blank and the word, with its bytes (and the blank) in the upper half."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT:
            self.clear()
        self[word] = known = (len(word) + 1) << 32 | zlib.crc32(b" " + word)
        return known


@cache
def _shift(size: int) -> np.ndarray:
    """What crc32 makes of a state when ``size`` bytes follow: a table for each byte of the state."""
    if size == 1:
        ends = np.array([zlib.crc32(b"\0", int(s)) ^ zlib.crc32(b"\0") for s in _unit_states()], np.uint32)
    else:
        ends = _moved(_moved(_unit_states(), _shift(size // 2)), _shift(size - size // 2))
    table = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for bit in range(8):
            table[k] ^= np.where(np.arange(256) >> bit & 1, ends[8 * k + bit], 0).astype(np.uint32)
    return table


def _unit_states() -> np.ndarray:
    return np.uint32(1) << np.arange(32, dtype=np.uint32)


def _moved(state: np.ndarray, table: np.ndarray) -> np.ndarray:
    parts = [table[k][(state >> np.uint32(8 * k)) & np.uint32(255)] for k in range(4)]
    return parts[0] ^ parts[1] ^ parts[2] ^ parts[3]


def _followed(state: np.ndarray, size: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """crc32 of each text with crc ``state`` when the text with ``crc`` and ``size`` bytes follows it."""
    out = np.empty_like(state)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        out[at] = _moved(state[at], _shift(n))
    return out ^ crc


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def bucket_counts(texts: list[str | None], known: _Words) -> Iterator[tuple[int, np.ndarray]]:
    """Words of each text, and how often its runs of one to three words meet each bucket."""
    held = [words_of(t) for t in texts]
    size = np.array([len(h) for h in held], np.int64)
    codes = np.fromiter((known[w] for h in held for w in h), np.int64, int(size.sum()))
    crc, length = (codes & 0xFFFFFFFF).astype(np.uint32), codes >> 32
    # The first word has no blank in front: the change that the blank makes is taken back.
    run = crc ^ _followed(np.full(len(crc), zlib.crc32(b" "), np.uint32), length - 1, np.zeros(len(crc), np.uint32))
    buckets = [run.astype(np.int64) % BUCKETS]
    for k in range(1, LONGEST_RUN):
        run = _followed(run[: len(run) - 1], length[k:], crc[k:]) if len(run) else run
        buckets.append(run.astype(np.int64) % BUCKETS)
    ends = np.cumsum(size)
    for i, (a, b) in enumerate(zip(ends - size, ends, strict=True)):
        found = [x[a : max(a, b - k)] for k, x in enumerate(buckets)]
        yield int(size[i]), np.bincount(np.concatenate(found), minlength=BUCKETS)


def planes(counts: np.ndarray) -> bytes:
    """The bit planes of non-negative integers, lowest first, one bit for each."""
    bits = int(counts.max(initial=0)).bit_length()
    return b"".join(np.packbits((counts >> i & 1).astype(np.uint8), bitorder="little").tobytes() for i in range(bits))


def _as_words(data: bytes) -> np.ndarray:
    """Planes as rows of 64-bit words."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, BUCKETS // 8)
    wide = np.zeros((len(rows), -(-BUCKETS // 64) * 8), np.uint8)
    wide[:, : BUCKETS // 8] = rows
    return wide.view(np.uint64)


def weight(held: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> int:
    """Sum of counts times gains, from the planes of both."""
    total = 0
    for gains, sign in ((positive, 1), (negative, -1)):
        for j, plane in enumerate(gains):
            common = np.bitwise_count(held & plane).sum(axis=1, dtype=np.int64)
            total += sign * sum(int(n) << (i + j) for i, n in enumerate(common))
    return total


def counted(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_key, n_words, n_features, planes) of every row."""
    kind = df.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                few = batch.slice(start, 128)
                found = [(n, int(c.sum()), planes(c)) for n, c in bucket_counts(few.column(2).to_pylist(), known)]
                n, features, bits = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [few.column(0), few.column(1), pa.array(n, pa.int64()), pa.array(features, pa.int64()), pa.array(bits, pa.binary())],
                    names=["doc_id", "text_key", "n_words", "n_features", "planes"],
                )

    rows = df.select(col(df, doc_id).alias("doc_id"), F.xxhash64(col(df, text)).alias("text_key"), col(df, text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, n_words long, n_features long, planes binary")


def totals(held: DataFrame) -> np.ndarray:
    """How often each bucket is met in all rows of counted(): one row a task, added up by Spark; BUCKETS rows come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for data in batch.column(0):
                rows = np.frombuffer(data.as_py(), np.uint8).reshape(-1, BUCKETS // 8)
                for i, plane in enumerate(rows):
                    total += np.unpackbits(plane, bitorder="little").astype(np.int64) << i
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    sums = held.select("planes").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    all_of = np.zeros(BUCKETS, object)
    for r in sums.collect():
        all_of[r.bucket] = int(r.n)
    return all_of


def gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 * log of the smoothed share in the target over the smoothed share in the corpus), by bucket."""
    big_s, big_t = sum(corpus), sum(target)
    return [
        math.floor(1000 * math.log((float(t) + 1) * (float(big_s) + BUCKETS) / ((float(s) + 1) * (float(big_t) + BUCKETS))))
        for s, t in zip(corpus, target, strict=True)
    ]


def weighed(held: DataFrame, gain: list[int]) -> DataFrame:
    """counted() with ``weight`` in place of the planes."""
    size = np.array(gain, np.int64)
    positive, negative = _as_words(planes(np.maximum(size, 0))), _as_words(planes(np.maximum(-size, 0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [weight(_as_words(p.as_py()), positive, negative) for p in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.int64())], names=["doc_id", "text_key", "n_words", "n_features", "weight"])

    kind = held.schema["doc_id"].dataType.simpleString()
    return held.mapInArrow(run, f"doc_id {kind}, text_key long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """A fixed Gumbel number of the id, in thousandths: the highest sums with it are a weighted draw without replacement."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = 5, least_words: int = 20, seed: int = 42,
) -> DataFrame:
    """(doc_id, text_key, n_words, n_features, weight, score, rank) of every row.

    Of the rows with ``least_words`` or more, ``percent`` in a hundred (rounded down) have a rank, from 1
    by falling score, then rising doc_id (a null id first), then text_key; the others have null. The log
    weight is in thousandths and the score adds noise() to it. Words are runs of letters, digits and
    non-ASCII characters; A-Z are folded. Null and empty texts have no features and weight 0. Repeated
    rows are ranked each. No documents, no rows; an empty target favours what is rare in the corpus.

    Texts are read once. What is kept between is BUCKETS bits a plane and row, what comes to the driver is
    BUCKETS numbers; ranks are places in one range sort of narrow rows.
    """
    rows = docs.select(col(docs, doc_id).alias("doc_id"), col(docs, text).alias("text"))
    held = saved(counted(rows, "doc_id", "text"), "planes", compression="zstd")
    wanted = target.select(F.lit(0).alias("doc_id"), col(target, target_text).alias("text"))
    gain = gains(totals(held), totals(counted(wanted, "doc_id", "text")))
    scored = weighed(held, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return _ranked(scored, percent, least_words)


def _ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    keys = [(F.col("n_words") >= least_words).desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("text_key")]
    scored = saved(scored, "scores")  # the range sort reads it twice
    ordered = scored.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = saved(ordered.withColumn("place", F.monotonically_increasing_id()), "ranks")
    part = F.shiftright(F.col("place"), 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count_if(F.col("n_words") >= least_words).alias("fit"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.withColumn("all_fit", F.sum("fit").over(whole)).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.expr(f"{int(percent)} * all_fit div 100").alias("drawn")
    )
    rank = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    joined = ordered.join(F.broadcast(starts), part == F.col("part"))
    return joined.select("doc_id", "text_key", "n_words", "n_features", "weight", "score", F.when(rank <= F.col("drawn"), rank).alias("rank"))
