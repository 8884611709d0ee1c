"""Sequence packing along a space-filling curve.

Each document's token ids are hashed into a small count vector, projected to three
dimensions and quantised; its Hilbert index is the sort key. Documents are range-sorted
by it and laid end to end, so neighbours on the curve share sequences. Each range is
packed by itself: full sequences, and a tail cut at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.base import col, saved
from landfall.llm.hilbert import curve_index
from landfall.llm.tokens import encoder, encoding

#: The hashed vector's size, the curve's dimensions and bits of each.
BUCKETS, DIMENSIONS, BITS = 256, 3, 8
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, token_ids binary"


def directions() -> np.ndarray:
    """The fixed random projection, from a seeded rule."""
    return np.random.default_rng(42).standard_normal((BUCKETS, DIMENSIONS)).astype(np.float32)


def levels(ids: np.ndarray, project: np.ndarray) -> np.ndarray:
    """Cell of a document: its unit count vector projected, one standard deviation at a quarter of the range."""
    counts = np.bincount((ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24), minlength=BUCKETS).astype(np.float32)
    point = counts @ project / max(1.0, float(np.linalg.norm(counts)))
    return np.clip((point + 2) * (1 << BITS) / 4, 0, (1 << BITS) - 1).astype(np.int64)


def encoded(df: DataFrame, doc_id: str, text: str, path: str, end_id: int) -> DataFrame:
    """(doc_id, curve, n, ids) of every row; ids end with ``end_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project = directions()
        enc = encoding(path)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [enc.ids(t.as_py()) + end for t in part.column(1)]
                cells = np.stack([levels(np.frombuffer(i, enc.dtype), project) for i in ids])
                n = [len(i) // enc.dtype.itemsize for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(curve_index(cells, BITS)), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "curve", "n", "ids"],
                )

    rows = df.select(col(df, doc_id).cast("long").alias("doc_id"), col(df, text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, curve long, n long, ids binary")


class Packer:
    """Lays documents end to end; holds the open sequence only."""

    def __init__(self, part: int, size: int, with_ids: bool) -> None:
        self.next, self.size, self.with_ids = part << 32, size, with_ids
        self.open: list[tuple[int | None, int, int, np.ndarray]] = []
        self.filled = 0
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple[int | None, int, int, np.ndarray]]) -> None:
        offset = 0
        for doc, start, tokens, ids in pieces:
            wide = ids.astype("<u4").tobytes()
            self.rows.append((doc, start, len(ids), zlib.crc32(wide), tokens, self.next, offset, wide if self.with_ids else None))
            offset += len(ids)
        self.next += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        start, tokens = 0, len(ids)
        while start < tokens:
            taken = ids[start : start + self.size - self.filled]
            self.open.append((doc, start, tokens, taken))
            self.filled += len(taken)
            start += len(taken)
            if self.filled == self.size:
                self._emit(self.open)
                self.open, self.filled = [], 0

    def close(self) -> None:
        """The tail, as sequences whose lengths are the powers of two in its length."""
        left = self.open
        for power in (1 << b for b in range(self.filled.bit_length() - 1, -1, -1) if self.filled >> b & 1):
            taken, room = [], power
            while room:
                doc, start, tokens, ids = left[0]
                taken.append((doc, start, tokens, ids[:room]))
                if len(ids) > room:
                    left[0], room = (doc, start + room, tokens, ids[room:]), 0
                else:
                    left, room = left[1:], room - len(ids)
            self._emit(taken)
        self.open, self.filled = [], 0

    def batch(self) -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "token_ids"]
        kinds = [pa.int64()] * 7 + [pa.binary()]
        columns = list(zip(*self.rows, strict=True)) or [()] * 8
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def pack(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", size: int = 2048, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, token_ids.

    Every id of every document is in exactly one piece; a sequence is full or its length
    is a power of two, so nothing is padded. Null and empty texts are the end id alone.
    token_ids are little-endian unsigned 32-bit ids (null without ``with_ids``). Ties on
    the curve go by doc_id (nulls first), then length; a hot cell is cut by these too.
    Repeated rows are packed each; an empty table gives no rows. sequence_id is unique,
    with the range in its upper 32 bits.
    """
    rows = saved(encoded(df, doc_id, text, path, end_id), "encoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, dtype = Packer(TaskContext.get().partitionId(), size, with_ids), encoder(path).dtype
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc, np.frombuffer(ids.as_buffer(), dtype))
                if len(packer.rows) >= 5000:
                    yield packer.batch()
        packer.close()
        yield packer.batch()

    keys = [F.col("curve"), F.col("doc_id").asc_nulls_first(), F.col("n")]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "ids").mapInArrow(run, _PIECE)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, token_ids) with the pieces joined; a group is one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "token_ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", F.expr("aggregate(p.token_ids, cast('' as binary), (a, b) -> a || b)").alias("token_ids"))
