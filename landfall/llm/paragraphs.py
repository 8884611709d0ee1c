"""Repeated paragraphs across documents: MinHash bands, exact Jaccard, clusters by components.

A line is a paragraph; a long one is cut before each long sentence, so that a passage
that was pasted into the middle of a line is met at the same places wherever it stands.
Equal paragraphs are one node from the start. Distinct ones meet in bands of their MinHash
signatures and are verified by the Jaccard similarity of their five-word shingles. Where no
such cut falls, windows of twenty words that begin at content-defined places are compared
word for word; those outside the repeated paragraphs are joined to passages.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.base import col, document_key, free_name, saved
from landfall.llm.components import components
from landfall.llm.groups import grouped, stars

#: Words of a shingle, least similarity, words of a sentence that begins a paragraph, words of a run that is cut out of texts.
SHINGLE, LEAST, ANCHOR, PASSAGE = 5, 0.8, 8, 20
#: Two values a band, five bands: a pair at 0.8 meets with probability 1 - (1 - 0.8**2)**5 = 0.994, at 0.9 with 0.9998.
BANDS, ROWS = 5, 2
_FACTORS = np.random.default_rng(5).integers(1, 1 << 63, SHINGLE + 2 * BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KEYS = [f"k{j}" for j in range(BANDS)]
#: Of so many places in a row one begins a window of PASSAGE words, so 40 equal words hold an equal window.
PICK = 21
_PLACES = np.random.default_rng(6).integers(1, 1 << 63, PASSAGE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _runs(one: np.ndarray) -> np.ndarray:
    return _mixed(sum((one[k : len(one) - SHINGLE + 1 + k] * _FACTORS[k] for k in range(SHINGLE)), np.uint64(0)))


def _short(one: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash for each run of ``size`` words, fewer than a shingle has."""
    padded = np.append(one, np.zeros(SHINGLE, np.uint64))
    return _mixed(sum(np.where(size > k, padded[begin + k], 0).astype(np.uint64) * _FACTORS[k] for k in range(SHINGLE - 1)) + size.astype(np.uint64))


class Cut(NamedTuple):
    """Words of many texts, one after the other: their hashes and first and last bytes; where paragraphs start; each text's first word (and the end)."""

    words: list[bytes]
    hashes: np.ndarray
    first: np.ndarray
    last: np.ndarray
    begin: np.ndarray
    text_word: np.ndarray
    text_byte: np.ndarray
    characters: np.ndarray | None

    def character(self, places: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Character positions of byte positions, in their texts."""
        if self.characters is None:
            return places - self.text_byte[text]
        return self.characters[places] - self.characters[self.text_byte[text]]


def cut(texts: list[str]) -> Cut:
    """Texts are laid out as lines of one buffer, so that a text begins a paragraph as a line does."""
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(coded)
    byte = np.frombuffer(data, np.uint8)
    text_byte = np.cumsum([0, *(len(c) + 1 for c in coded)])[:-1]
    inside = ~((byte == 32) | ((byte >= 9) & (byte <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    first, last = edge[::2], edge[1::2]
    line = np.concatenate([[0], np.cumsum(byte == 10)])[first]
    opens = np.concatenate([[True], line[1:] != line[:-1]])[: len(first)]
    ends = np.isin(byte[last - 1], np.frombuffer(b".!?", np.uint8)) if len(last) else np.empty(0, bool)
    sentence = np.flatnonzero(opens | np.concatenate([[False], ends[:-1]])[: len(first)])
    long_one = np.diff(np.append(sentence, len(first))) >= ANCHOR
    words = data.lower().split()
    text_word = np.append(np.searchsorted(first, text_byte), len(first))
    characters = None if len(data) == sum(map(len, texts)) + len(texts) - 1 else np.concatenate([[0], np.cumsum((byte & 0xC0) != 0x80)])
    return Cut(words, _hashes(words), first, last, sentence[long_one | opens[sentence]], text_word, text_byte, characters)


def _least_of(runs: np.ndarray, width: int) -> np.ndarray:
    """For each place, where the least of the next ``width`` values stands (the first of equals)."""
    at, reach = np.arange(len(runs)), 1
    while reach < width:
        step = min(reach, width - reach)
        near, far = at[:-step], at[step:]
        at = np.where(runs[near] <= runs[far], near, far)
        reach += step
    return at


def windows(c: Cut) -> tuple[np.ndarray, ...]:
    """Windows of PASSAGE words at the least shingle of PICK in a row: text, first word, paragraph, first character, end, hash."""
    none = np.empty(0, np.int64)
    start, stop = c.text_word[:-1], c.text_word[1:] - PASSAGE  # the places where a window can begin
    if not (stop >= start).any():
        return (none,) * 6
    runs = _runs(c.hashes)
    wide = stop - start + 1 >= PICK
    picks = [start[i] + runs[start[i] : stop[i] + 1].argmin(keepdims=True) for i in np.flatnonzero(~wide & (stop >= start))]
    if wide.any():
        text = np.repeat(np.arange(len(start)), c.text_word[1:] - c.text_word[:-1])
        place = np.arange(len(text))
        picks.append(_least_of(runs, PICK)[place[wide[text] & (place + PICK - 1 <= stop[text])]])
    at = np.unique(np.concatenate([none, *picks]))
    own = _mixed(sum((c.hashes[at + k] * _PLACES[k] for k in range(PASSAGE)), np.uint64(0)))
    text = np.searchsorted(c.text_word, at, "right") - 1
    first_paragraph = np.searchsorted(c.begin, c.text_word[:-1])
    paragraph = np.searchsorted(c.begin, at, "right") - 1 - first_paragraph[text]
    ends = c.character(c.last[at + PASSAGE - 1], text)
    return text, at - c.text_word[text], paragraph, c.character(c.first[at], text), ends, own.view(np.int64)


def signatures(c: Cut) -> tuple[np.ndarray, ...]:
    """Paragraphs: text, first word, first character, characters, words, hash, and a column of each band's keys."""
    begin, words = c.begin, c.words
    size = np.diff(np.append(begin, len(words)))
    text = np.searchsorted(c.text_word, begin, "right") - 1
    whole = size >= SHINGLE
    short = _short(c.hashes, begin[~whole], size[~whole])
    runs = _runs(c.hashes) if whole.any() else c.hashes[:0]
    spans = np.stack([begin[whole], (begin + size)[whole] - SHINGLE + 1], axis=1).ravel()
    if len(spans) and spans[-1] >= len(runs):
        spans = spans[:-1]

    def least(k: int) -> np.ndarray:
        value = lambda x: _mixed(x ^ _FACTORS[SHINGLE + k]) * _FACTORS[SHINGLE + BANDS * ROWS + k]
        low = np.empty(len(size), np.uint64)
        low[~whole] = value(short)
        if len(spans):
            low[whole] = np.minimum.reduceat(value(runs), spans)[::2]
        return low

    keys = [_mixed(sum((least(j * ROWS + r) * _FACTORS[r] for r in range(ROWS)), np.uint64(0)) + np.uint64(j)).view(np.int64) for j in range(BANDS)]
    own = np.fromiter((xxhash.xxh3_64_intdigest(b" ".join(words[a : a + n])) for a, n in zip(begin.tolist(), size.tolist(), strict=True)), np.uint64, len(begin))
    a, z = c.character(c.first[begin], text), c.character(c.last[begin + size - 1], text)
    return text, begin - c.text_word[text], a, z - a, size, own.view(np.int64), *keys


_PARAGRAPH = ["at", "start", "length", "words", "node", *_KEYS]
_WINDOW = ["w_at", "w_paragraph", "w_start", "w_stop", "w_node"]


def _lists(text: np.ndarray, values: np.ndarray, texts: int, kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=texts))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(kind.to_pandas_dtype())))


def _texts(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(*document_key(col(df, doc_id), col(df, text)), col(df, text).alias("text"))


def _digests(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row for each text: its paragraphs and its windows as lists, made from one cut."""
    kind = df.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                few = batch.slice(at, 500)
                c = cut([t or "" for t in few.column(2).to_pylist()])
                of, *columns = signatures(c)
                made = [_lists(of, x, few.num_rows, pa.int64() if k in ("node", *_KEYS) else pa.int32()) for k, x in zip(_PARAGRAPH, columns, strict=True)]
                of, *columns = windows(c)
                made += [_lists(of, x, few.num_rows, pa.int64() if k == "w_node" else pa.int32()) for k, x in zip(_WINDOW, columns, strict=True)]
                yield pa.RecordBatch.from_arrays([few.column(0), few.column(1), *made], names=["doc_id", "text_key", *_PARAGRAPH, *_WINDOW])

    columns = ", ".join(f"{k} array<{'long' if 'node' in k or k in _KEYS else 'int'}>" for k in [*_PARAGRAPH, *_WINDOW])
    return _texts(df, doc_id, text).mapInArrow(run, f"doc_id {kind}, text_key long, {columns}")


def _listed(digests: DataFrame, names: list[str], number: str | None = None) -> DataFrame:
    """A row for each element of the lists ``names``."""
    zipped = F.arrays_zip(*names)
    if number is None:
        return digests.select("doc_id", "text_key", F.inline(zipped))
    return digests.select("doc_id", "text_key", F.posexplode(zipped).alias(number, "_x")).select("doc_id", "text_key", number, "_x.*")


def _within(rows: DataFrame, side: DataFrame, on: str, broadcast_rows: int) -> DataFrame:
    """``rows`` joined with the saved ``side``, a few numbers a row, which is counted and broadcast up to ``broadcast_rows``."""
    return rows.join(F.broadcast(side) if side.count() <= broadcast_rows else side, on)


def _shingle_sets(docs: DataFrame, places: DataFrame, doc_id: str, text: str, broadcast_rows: int) -> DataFrame:
    """(node, sh): the distinct shingle hashes of one occurrence of each wanted paragraph."""
    places = saved(places, "places")
    side = F.broadcast(places) if places.count() <= broadcast_rows else places
    rows = _texts(docs, doc_id, text)
    same = rows.doc_id.eqNullSafe(side["at.doc_id"]) & (rows.text_key == side["at.text_key"])
    texts = rows.join(side, same).select("node", F.expr("substring(text, at.start + 1, at.length)").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                few = batch.slice(at, 2000)
                c = cut(few.column(1).to_pylist())  # paragraphs hold no line ends, so each is a text of its own
                begin, size = c.text_word[:-1], np.diff(c.text_word)
                whole = size >= SHINGLE
                of = np.repeat(np.arange(len(size)), np.where(whole, size - SHINGLE + 1, 1))
                found = np.empty(len(of), np.uint64)
                found[~whole[of]] = _short(c.hashes, begin[~whole], size[~whole])
                if whole.any():
                    place = np.arange(len(c.hashes))
                    owner = np.repeat(np.arange(len(size)), size)
                    found[whole[of]] = _runs(c.hashes)[place[whole[owner] & (place + SHINGLE <= (begin + size)[owner])]]
                order = np.lexsort([found, of])
                of, found = of[order], found[order]
                kept = np.concatenate([[True], (of[1:] != of[:-1]) | (found[1:] != found[:-1])])
                of, found = of[kept], found[kept].view(np.int64)
                yield pa.RecordBatch.from_arrays([few.column(0), _lists(of, found, few.num_rows, pa.int64())], names=["node", "sh"])

    # Repeated rows of one document give their paragraph more than once.
    return saved(texts.mapInArrow(run, "node long, sh array<long>").groupBy("node").agg(F.any_value("sh").alias("sh")), "shingles")


def similar(members: list[np.ndarray], least: float, cells: int = 1 << 22) -> np.ndarray:
    """Matrix of Jaccard >= least of sets of hashes, by products of slices of their incidence matrix of at most ``cells`` cells."""
    size = np.array([len(m) for m in members])
    row = np.repeat(np.arange(len(members)), size)
    _, column, count = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(members), len(members)), np.float64)
    step = max(1, cells // max(1, len(members)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, z = np.searchsorted(column, [low, low + step])
        held = np.zeros((len(members), min(step, int(column[z - 1]) - low + 1)), np.float32)
        held[row[a:z], column[a:z] - low] = 1
        common += held @ held.T
    np.fill_diagonal(common, size)
    return common >= least * (size[:, None] + size[None, :] - common) - 1e-6


def _verified_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar."""
    of = lambda k: sets.select(F.col("node").alias(k), F.col("sh").alias(f"sh_{k}"))
    held = pairs.join(of("a"), "a").join(of("b"), "b")
    common = F.size(F.array_intersect("sh_a", "sh_b"))
    return held.filter(common >= LEAST * (F.size("sh_a") + F.size("sh_b") - common) - 1e-6).select("a", "b")


def _edges(members: DataFrame, sets: DataFrame, block: int, block_words: int) -> DataFrame:
    """Edges (a, b) that span the verified links of each large bucket, compared in blocks of so many members, or words."""
    chunks = F.ceil(F.greatest(F.col("n") / block, F.col("total") / block_words))
    rows = members.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    rows = rows.select("key", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "node").join(sets, "node")
    keys = ["key", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, keys, least=2):
            yield stars(group["node"].to_numpy(), similar(_members_of(group["sh"].combine_chunks()), LEAST))

    return rows.select(*keys, "node", "sh").repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(run, "a long, b long")


def _members_of(lists: pa.ListArray) -> list[np.ndarray]:
    ends = lists.offsets.to_numpy()
    flat = lists.flatten().to_numpy()
    return [flat[a - ends[0] : z - ends[0]] for a, z in zip(ends[:-1], ends[1:], strict=True)]


def _flat(lists: pa.ListArray) -> tuple[pa.StructArray, np.ndarray]:
    """All elements of the lists, and the list that each is in."""
    lists = lists.fill_null([]) if lists.null_count else lists
    return lists.flatten(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))


def _numbers(rows: pa.StructArray, *names: str) -> list[np.ndarray]:
    return [rows.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def joined(known: pa.ListArray, found: pa.ListArray) -> tuple[np.ndarray, ...]:
    """Passages of many texts: windows joined where they copy one place, without the paragraphs ``known``.

    Of each: its text, first word, end, first character, end, paragraph, the greatest count of its
    windows, which window (of all in the lists) it begins with, and the words of the run of
    neighbouring paragraphs and passages it lies in. No two of a text overlap; words shared by two windows
    that copy different places go to the later one.
    """
    (spans, of), (wins, text) = _flat(known), _flat(found)
    k_at, k_end, k_start, k_stop, k_paragraph = _numbers(spans, "at", "end", "start", "stop", "paragraph")
    at, end, start, stop, paragraph, n = _numbers(wins, "at", "end", "start", "stop", "paragraph", "n")
    from_key, from_at = _numbers(wins.field("first"), "text_key", "at")
    from_id = wins.field("first").field("doc_id").dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    order = np.lexsort([at, text])
    label = np.stack([text, from_id, from_key, from_at - at])[:, order]
    new = np.concatenate([[True], (label[:, 1:] != label[:, :-1]).any(axis=0) | (np.diff(at[order]) > PASSAGE)])[: len(order)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(order))[: len(first)] - 1
    head, tail = order[first], order[last]
    most = np.maximum.reduceat(n[order], first) if len(first) else n
    s_text, s_at, s_end, s_start, s_stop = text[head], at[head], end[tail], start[head], stop[tail]
    follows = np.flatnonzero((s_text[1:] == s_text[:-1]) & (s_at[1:] < s_end[:-1]))
    s_end[follows], s_stop[follows] = s_at[follows + 1], s_start[follows + 1]

    order = np.lexsort([k_at, of])
    of, k_at, k_end, k_start, k_stop, k_paragraph = (x[order] for x in (of, k_at, k_end, k_start, k_stop, k_paragraph))
    wide = int(max(s_end.max(initial=0), k_end.max(initial=0))) + 1
    low = np.searchsorted(of * wide + k_end, s_text * wide + s_at, "right")
    high = np.maximum(low, np.searchsorted(of * wide + k_at, s_text * wide + s_end, "left"))
    gaps = high - low + 1  # a passage is cut by the paragraphs in it
    which = np.repeat(np.arange(len(gaps)), gaps)
    gap = np.arange(len(which)) - np.repeat(np.cumsum(gaps) - gaps, gaps)
    before, after = low[which] + gap - 1, low[which] + gap
    opens, closes = gap == 0, gap == gaps[which] - 1
    pick = lambda own, other, flag, k: np.where(flag, own[which], other[np.clip(k, 0, max(0, len(other) - 1))] if len(other) else own[which])
    p_at, p_start = pick(s_at, k_end, opens, before), pick(s_start, k_stop, opens, before)
    p_end, p_stop = pick(s_end, k_at, closes, after), pick(s_stop, k_start, closes, after)
    p_paragraph = pick(paragraph[head], k_paragraph + 1, opens, before)
    kept = np.flatnonzero(p_at < p_end)
    which, p_at, p_end, p_start, p_stop, p_paragraph = (x[kept] for x in (which, p_at, p_end, p_start, p_stop, p_paragraph))
    p_text = s_text[which]

    every, begins, stops = np.concatenate([p_text, of]), np.concatenate([p_at, k_at]), np.concatenate([p_end, k_end])
    order = np.lexsort([begins, every])
    every, begins, stops = every[order], begins[order], stops[order]
    new = np.concatenate([[True], (every[1:] != every[:-1]) | (begins[1:] != stops[:-1])])[: len(order)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(order))[: len(first)] - 1
    run = np.empty(len(order), np.int64)
    run[order] = (stops[last] - begins[first])[np.cumsum(new) - 1]
    return p_text, p_at, p_end, p_start, p_stop, p_paragraph, most[which], head[which], run[: len(p_text)]


def _passages(digests: DataFrame, kind: str, hits: DataFrame, broadcast_rows: int) -> DataFrame:
    """Rows like those of repeated(): what repeats word for word outside the paragraphs ``hits``."""
    counts = digests.select(F.explode("w_node").alias("w_node")).groupBy("w_node").agg(F.count("*").alias("n")).filter("n > 1")
    counts = saved(counts, "equal-hashes")
    many = _within(_listed(digests, _WINDOW), counts, "w_node", broadcast_rows)
    if counts.count() > broadcast_rows:
        many = saved(many, "equal-windows")  # it is read twice, and the join shuffles all windows
    many = many.select("doc_id", "text_key", "n", *[F.col(w).alias(w[2:]) for w in _WINDOW])
    spot = F.struct(F.col("doc_id").isNotNull().alias("set"), "doc_id", "text_key", "at", "paragraph")
    firsts = many.groupBy("node").agg(F.min(spot).alias("first"), F.max(spot).alias("last"), (F.max("at") - F.min("at")).alias("apart"))
    same = F.col("first.doc_id").eqNullSafe(F.col("last.doc_id")) & (F.col("first.text_key") == F.col("last.text_key"))
    firsts = firsts.filter(~same | (F.col("apart") >= PASSAGE)).select("node", "first")  # not merely with itself
    key = ["doc_id", "text_key"]
    window = F.struct("at", (F.col("at") + PASSAGE).alias("end"), "start", "stop", "paragraph", "n", "first")
    paragraph = F.struct("at", (F.col("at") + F.col("words")).alias("end"), "start", (F.col("start") + F.col("length")).alias("stop"), "paragraph")
    # One text's windows and paragraphs; equal rows of a document count as copies.
    found = many.join(firsts, "node").groupBy(*key).agg(F.collect_set(window).alias("found"), F.count("*").alias("rows"))
    known = hits.groupBy(*key).agg(F.collect_set(paragraph).alias("known")).select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "known")
    spans = found.join(known, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left").select(*key, "known", "found", "rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, at, end, start, stop, paragraph, n, window, run_words = joined(batch.column(2), batch.column(3))
            wins, of = _flat(batch.column(3))
            copies = batch.column(4).to_numpy() // np.maximum(1, np.bincount(of, minlength=batch.num_rows))
            again = np.repeat(np.arange(len(text)), copies[text])  # equal rows of a document
            few, begun = batch.select(key).take(pa.array(text[again])), wins.take(pa.array(window[again]))
            first = begun.field("first")
            shift = _numbers(first, "at")[0] - _numbers(begun, "at")[0]
            columns = [pa.array(x[again].astype(np.int32)) for x in (paragraph, start, stop - start, end - at)]
            yield pa.RecordBatch.from_arrays(
                [
                    *few.columns, *columns, pa.array(n[again]), first.field("doc_id"), first.field("paragraph"), first.field("text_key"),
                    pa.array(shift), pa.array(run_words[again]),
                ],
                names=[*key, "paragraph", "start", "length", "words", "cluster_size", "keep_doc_id", "keep_paragraph", "keep_key", "shift", "run_words"],
            )

    made = spans.mapInArrow(
        run, f"doc_id {kind}, text_key long, paragraph int, start int, length int, words int, cluster_size long, keep_doc_id {kind}, "
        "keep_paragraph int, keep_key long, shift long, run_words long",
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_doc_id")) & (F.col("text_key") == F.col("keep_key")) & (F.col("shift") == 0)
    return made.withColumn("removed", ~kept).drop("keep_key", "shift")


def repeated(df: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = 512, broadcast_rows: int = 2_000_000, block_words: int = 1_000_000) -> DataFrame:
    """The repeated paragraphs, one row each occurrence, kept and removed ones.

    Columns: doc_id, text_key, paragraph (its number in the document), start and length in
    characters, words, cluster_size, keep_doc_id, keep_paragraph, removed, run_words. The
    occurrence with the smallest doc_id and number stays (null ids first). A paragraph counts if
    it has another occurrence, in this or another document, with a similarity of 0.8 or more by
    chains of such; under five words that is the same words. run_words is the words of the run
    of such neighbours it lies in: filter on it to leave short repeats alone. Words are runs
    without blanks; A-Z are folded. Null and empty texts have none.

    Outside these paragraphs passages are reported that stand elsewhere word for word: all of
    40 words or more, and those of 20 to 39 that hold a window. Such a row has the number of the
    paragraph it begins in, its own start, length and words (it may end in a blank), and a run
    with the paragraphs beside it. Rows of one text never overlap.
    """
    digests = saved(_digests(df, doc_id, text), "digests", compression="zstd")
    rows = _listed(digests, ["at", "start", "length", "words", "node"], "paragraph")
    nodes = digests.select(F.explode("node").alias("node")).groupBy("node").agg(F.count("*").alias("n"))
    entries = digests.select(F.inline(F.arrays_zip("node", "words", *_KEYS))).select("node", "words", F.explode(F.array(*_KEYS)).alias("key"))
    shared = saved(entries.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("key"), "shared-keys")
    members = saved(_within(entries, shared, "key", broadcast_rows).distinct(), "members")
    sizes = [F.count("*").alias("n"), F.sum("words").alias("total"), F.min("node").alias("a"), F.max("node").alias("b")]
    buckets = saved(members.groupBy("key").agg(*sizes), "buckets")
    pairs = saved(buckets.filter("n = 2").select("a", "b").distinct(), "pairs")
    wanted = members.select("node").distinct()
    members = _within(members.select("key", "node"), saved(buckets.filter("n > 2").select("key", "n", "total"), "large-buckets"), "key", broadcast_rows)
    at = F.struct("doc_id", "text_key", "start", "length")
    places = _within(rows, saved(wanted, "wanted"), "node", broadcast_rows).groupBy("node").agg(F.min(at).alias("at"))
    sets = _shingle_sets(df, places, doc_id, text, broadcast_rows)
    links = _verified_pairs(pairs, sets).unionByName(_edges(members, sets, block, block_words))
    roots = components(links).select("node", "root")
    classes = nodes.select("node", "n").join(roots, "node", "left").select("node", "n", F.coalesce("root", "node").alias("root"))
    sizes = classes.groupBy("root").agg(F.sum("n").alias("cluster_size")).filter("cluster_size > 1")
    many = saved(classes.join(sizes, "root").select("node", "root", "cluster_size"), "clusters")
    hits = saved(_within(rows, many, "node", broadcast_rows), "occurrences")

    first = hits.groupBy("root").agg(F.min(F.struct(hits.doc_id.isNotNull().alias("set"), "doc_id", "text_key", "paragraph")).alias("first"))
    document = ["doc_id", "text_key"]
    order = Window.partitionBy(*document).orderBy("paragraph")  # at most the paragraphs of one text
    island = hits.withColumn("run", F.col("paragraph") - F.dense_rank().over(order))
    in_run = Window.partitionBy(*document, "run")
    copy = F.row_number().over(Window.partitionBy(*document, "paragraph").orderBy("node"))  # repeated rows of one document
    island = island.withColumn("copy", copy).withColumn("run_words", F.sum(F.when(F.col("copy") == 1, F.col("words"))).over(in_run))
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")) & (F.col("paragraph") == F.col("first.paragraph"))
    found = island.join(first, "root").select(
        "doc_id", "text_key", "paragraph", "start", "length", "words", "cluster_size",
        F.col("first.doc_id").alias("keep_doc_id"), F.col("first.paragraph").alias("keep_paragraph"), (~kept).alias("removed"), "run_words",
    )
    kind = df.schema[doc_id].dataType.simpleString()
    return found.unionByName(_passages(digests, kind, hits, broadcast_rows))


def without_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", run_words: int = PASSAGE) -> DataFrame:
    """``df`` with the removed paragraphs and passages in runs of ``run_words`` or more cut out of its texts; all rows and other columns stay."""
    gone = repeated(df, doc_id, text).filter(F.col("removed") & (F.col("run_words") >= run_words)).groupBy("doc_id", "text_key")
    spots, at_id, at_key = (free_name(df, n) for n in ("_spans", "_at_id", "_at_key"))
    spans = gone.agg(F.sort_array(F.collect_set(F.struct("start", "length")), asc=False).alias(spots))
    spans = spans.withColumnsRenamed({"doc_id": at_id, "text_key": at_key})
    joined = df.join(spans, col(df, doc_id).eqNullSafe(F.col(at_id)) & (F.xxhash64(col(df, text)) == F.col(at_key)), "left")
    name = "`" + text.replace("`", "``") + "`"
    short = F.expr(
        f"coalesce(aggregate({spots}, {name}, (t, s) -> concat(substring(t, 1, s.start), substring(t, s.start + s.length + 1))), {name})"
    )
    return joined.withColumn(text, short).drop(at_id, at_key, spots)
