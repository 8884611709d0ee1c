"""Token ids in ORC files: integer run-length encoding, row indexes, Bloom filters on document ids.

Files are written in ascending doc_id order, one range a file, and split by stripe when
read; doc_id predicates skip stripes and row groups by the indexes and the filter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm.base import BATCH_BYTES, col, shared_dir
from landfall.llm.tokens import encoding

OPTIONS = {
    "orc.compress": "ZSTD",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.create.index": "true",
}
_ROW = "part int, doc_id long, start_in_part long, n_tokens long, token_ids array<int>"


def _of_bytes(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in order, in slices of about ``most`` bytes of text in column 1, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.flatnonzero(np.diff(np.cumsum(sizes) // most, prepend=-1)).tolist()
    for start, stop in pairwise([*starts, batch.num_rows]):
        yield batch.slice(start, stop - start)


def write_tokens(df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 1, path: str | None = None) -> str:
    """Encodes whole texts and writes the files; returns their folder.

    Null and empty texts are the end id alone. Null ids come first; rows with equal ids
    follow each other by the hash of their text. Repeated rows are written each. The texts
    are range-sorted before they are encoded, so the sample of the range sort runs no
    tokenizer and only texts shuffle.
    """
    path = path or shared_dir(df.sparkSession, "token-orc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        enc = encoding(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            for few in _of_bytes(batch, BATCH_BYTES):
                ids = [i + end for i in enc.many(few.column(1).to_pylist())]
                n = np.array([len(i) // enc.dtype.itemsize for i in ids], np.int64)
                ends = np.cumsum(n)
                flat = np.frombuffer(b"".join(ids), enc.dtype).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), few.column(0), pa.array(done + ends - n), pa.array(n), lists],
                    names=["part", "doc_id", "start_in_part", "n_tokens", "token_ids"],
                )
                done += int(ends[-1])

    rows = df.select(col(df, doc_id).cast("long").alias("doc_id"), col(df, text).alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.mapInArrow(run, _ROW).write.options(**OPTIONS).orc(path)
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files as (doc_id, start, n_tokens, token_ids); start counts the ids of all documents before."""
    files = spark.read.schema(_ROW).orc(path)
    sizes = files.groupBy("part").agg(F.max(F.col("start_in_part") + F.col("n_tokens")).alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    starts = sizes.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("ids_before"))
    return files.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("ids_before") + F.col("start_in_part")).alias("start"), "n_tokens", "token_ids"
    )


def digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of read_tokens(); n_tokens is counted from the ids read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat, ends = lists.flatten().to_numpy().astype("<u4", copy=False), lists.offsets.to_numpy()
            ends = ends - ends[0]
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "token_ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
