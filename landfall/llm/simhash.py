"""SimHash near-dedup with covering masks: every pair within the radius meets in some table.

The masks come from a covering code: bit i of a fingerprint gets a non-zero vector of
radius + 1 bits, and table v keeps the bits whose vector has an odd product with v.
Up to ``radius`` differing bits give at most ``radius`` linear conditions on v, so some
v that isn't zero keeps none of them: the two fingerprints agree in that table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.base import col, document_key, saved, without
from landfall.llm.components import components
from landfall.llm.groups import grouped, stars

SEED = 42
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACES = (np.arange(8, dtype=np.uint16) * 256)[None, :]


def fingerprint(text: str | None, width: int = 4) -> int:
    """64 bits of a text, unsigned: bit b is 1 if set in over half of the hashes of its word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False)) if len(words) > width else [b" ".join(words)]
    count = max(1, len(words) - width + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, count)
    seen = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _PLACES).ravel(), minlength=2048).reshape(8, 256)
    ones = (seen @ _BYTE_BITS).ravel()
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, doc_id: str, text: str, width: int = 4) -> DataFrame:
    """(doc_id, text_key, bits) of every row; bits is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits.view(np.int64))], names=["doc_id", "text_key", "bits"])

    rows = df.select(*document_key(col(df, doc_id), col(df, text)), col(df, text).alias("text"))
    kind = df.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, bits long")


def masks(radius: int) -> list[int]:
    """The covering masks, 2**(radius + 1) - 1 of them, as signed longs; for radii up to 6."""
    if not 0 <= radius <= 6:
        raise ValueError("radius must be between 0 and 6")
    vectors = (1 << (radius + 1)) - 1
    kept = lambda v: sum(1 << i for i in range(64) if ((1 + i % vectors) & v).bit_count() % 2)
    return [int(np.uint64(kept(v)).astype(np.int64)) for v in range(1, vectors + 1)]


def tables(bits: Column, radius: int) -> Column:
    """One struct (tbl, part) for each mask."""
    return F.explode(F.array(*[F.struct(F.lit(t).alias("tbl"), bits.bitwiseAND(F.lit(m)).alias("part")) for t, m in enumerate(masks(radius))]))


def links(distinct_bits: DataFrame, radius: int, block: int = 1024) -> DataFrame:
    """Edges (a, b) that span the graph of fingerprints with at most ``radius`` differing bits.

    Buckets of two are checked as they are. Larger ones are compared in blocks of
    ``block`` x ``block`` members, each a small task-local matrix; a block returns only the
    edges of a spanning forest, never its pairs.
    """
    entries = distinct_bits.select("bits", tables(F.col("bits"), radius).alias("at")).select("bits", "at.tbl", "at.part")
    buckets = entries.groupBy("tbl", "part").agg(F.count("*").alias("n"), F.min("bits").alias("a"), F.max("bits").alias("b")).filter("n > 1")
    buckets = saved(buckets, "buckets")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    two = buckets.filter("n = 2").filter(near).select("a", "b")
    many = entries.join(buckets.filter("n > 2").select("tbl", "part", "n"), ["tbl", "part"])
    chunks = F.ceil(F.col("n") / block)
    many = many.withColumn("chunk", F.pmod(F.xxhash64("bits"), chunks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    many = many.select("tbl", "part", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "bits")
    keys = ["tbl", "part", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, keys):
            member = group.column("bits").to_numpy()
            close = np.bitwise_count(member[:, None] ^ member[None, :]) <= radius
            yield stars(member, close)

    compared = many.repartition(*keys).sortWithinPartitions(*keys, "bits").mapInArrow(run, "a long, b long")
    return two.unionByName(compared)


def near_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, text_key, fingerprint, component_id) of every row.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the smallest
    doc_id reachable (null only if all ids there are null). Null and blank texts have
    fingerprint zero and link like any other. Equal fingerprints are one node, so a group
    of copies adds no edges. Repeated rows each get their row; an empty table gives none.
    """
    rows = saved(fingerprints(df, doc_id, text, width), "fingerprints")
    nodes = saved(rows.groupBy("bits").agg(F.min("doc_id").alias("low")), "nodes")
    roots = components(links(nodes.select("bits"), radius))
    placed = nodes.join(roots, nodes.bits == roots.node, "left").select("bits", "low", F.coalesce("root", "bits").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = saved(placed.join(lowest, "root").select("bits", "component_id"), "classes")
    return rows.join(classes, "bits").select(
        "doc_id", "text_key", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """``df`` with one document of each component: the one with the smallest doc_id.

    Rows that carry that id more than once stay together, as they are one document.
    """
    classes = near_copies(df, doc_id, text, width, radius)
    gone = saved(classes.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "text_key").distinct(), "near-copies")
    return without(df, gone, doc_id, text)
