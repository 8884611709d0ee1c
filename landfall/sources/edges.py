"""Text that is cut into records by many tasks: stretches of a file split, and the pieces that reach over its edges."""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from landfall.functions.sql import lit
from landfall.sources.scan import scan_text

#: What becomes of a split in a file that ends where it must not: nothing, what never closes begins in it, all of it lies behind that.
SOUND, TORN, BEHIND = 0, 1, 2
#: A piece is a whole record, or the end, the middle or the beginning of one.
FULL, HEAD, WHOLE, TAIL = "full", "head", "whole", "tail"
PIECE = "_source_file string, _source_ts timestamp, _block long, kind string, value string"
_NAMES = ["_source_file", "_source_ts", "_block", "kind", "value"]
_KINDS = [pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.string(), pa.string()]


def scan_splits(spark: SparkSession, paths: str | Sequence[str], separator: str) -> DataFrame:
    """Chunks between separators, with numbers for their file and where their split begins in it."""
    chunks = scan_text(spark, paths, line_sep=separator, extent=True).drop("_size")
    return chunks.withColumn("_file", F.xxhash64("_source_file"))


def stretches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The parts of a batch that come from one file split each."""
    files, blocks = batch.column("_file").to_numpy(), batch.column("_block").to_numpy()
    edges = [0, *(np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(edges, edges[1:]) if b > a)


def folded_by_file(told: DataFrame, order: Sequence[str], fold: Callable[[list], list[tuple]], schema: pa.Schema, ddl: str) -> DataFrame:
    """What ``fold`` makes of the rows of each ``file``, in order; one file at a time is held, and many small ones share a task."""
    row = namedtuple("row", told.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row(*r) for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        made = (m for _, file in groupby(rows, lambda r: r.file) for m in fold(list(file)))
        while few := list(islice(made, 5000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*few, strict=True), schema, strict=True)], schema=schema)

    return told.repartition("file").sortWithinPartitions("file", *order).mapInArrow(run, ddl)


def place_of(part: pa.RecordBatch) -> tuple[int, int]:
    return part.column("_file")[0].as_py(), part.column("_block")[0].as_py()


class Split:
    """Puts the chunks of one file split together to pieces."""

    def __init__(self, part: pa.RecordBatch) -> None:
        self.place = place_of(part)
        self.origin = [part.column(n)[0].as_py() for n in ("_source_file", "_source_ts", "_block")]
        self.ended = False

    def unchanged(self, part: pa.RecordBatch) -> bool:
        """Whether each of these chunks is a record of its own."""
        return False

    def add(self, part: pa.RecordBatch) -> Iterator[tuple]:
        raise NotImplementedError

    def close(self) -> Iterator[tuple]:
        raise NotImplementedError

    def piece(self, kind: str, value: str) -> tuple:
        return (*self.origin, kind, value)


def assembled(split_of: Callable[[pa.RecordBatch], Split], full: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The whole records of a partition, or the pieces at the edges of its splits."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        rows = [r for r in rows if (r[3] == FULL) == full]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_KINDS)], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            for part in stretches(batch):
                if split is None or split.place != place_of(part):
                    if split:
                        yield batch_of(list(split.close()))
                    split = split_of(part)
                if not split.unchanged(part):
                    yield batch_of(list(split.add(part)))
                elif full:
                    kind = pa.array([FULL]).take(pa.array(np.zeros(part.num_rows, np.int32)))
                    origin = [part.column(n) for n in _NAMES[:3]]
                    yield pa.RecordBatch.from_arrays([*origin, kind, part.column("value")], names=_NAMES)
        if split:
            yield batch_of(list(split.close()))

    return run


def records(begun: DataFrame, with_edges: DataFrame, split_of: Callable[[pa.RecordBatch], Split], separator: str) -> DataFrame:
    """(value, _source_file, _source_ts, closed) of every record; only what reaches over an edge is shuffled, a row or two a split.

    ``with_edges`` are the chunks of the files that may have such pieces.
    """
    full = begun.mapInArrow(assembled(split_of, True), PIECE).withColumn("closed", F.lit(True))
    edges = with_edges.mapInArrow(assembled(split_of, False), PIECE)
    place = F.expr(f"CASE kind WHEN '{HEAD}' THEN 0 WHEN '{WHOLE}' THEN 1 ELSE 2 END")
    order = Window.partitionBy("_source_file").orderBy("_block", "place")
    seams = edges.withColumn("place", place).withColumn("seam", F.sum(F.expr(f"cast(kind = '{TAIL}' as int)")).over(order))
    joined = seams.groupBy("_source_file", "seam").agg(
        F.min("_source_ts").alias("_source_ts"), F.expr(f"bool_or(kind = '{HEAD}') AS closed"),
        F.expr(f"array_join(transform(array_sort(collect_list(struct(_block, place, value))), p -> p.value), {lit(separator)}) AS value"),
    )
    columns = ["value", "_source_file", "_source_ts", "closed"]
    return full.select(columns).unionByName(joined.select(columns))
