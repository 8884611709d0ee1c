"""Exact dedup in two passes over the texts with a Bloom filter between them.

Pass 1 counts, per filter bit, how often any text sets it, and keeps the bits set at
least twice as bitmaps. In pass 2 a text with a bit outside them is unique for
certain and passes straight through; only the rest shuffles, grouped by SHA-256.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.base import BLANKS, col, free_name, saved

#: Bits of one bitmap, as the built-in bitmap functions cut them.
BLOCK_BITS = 32_768


def without_blanks(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{BLANKS}]+", "")


def _positions(digest: Column, blocks: int) -> tuple[Column, Column]:
    """Block of a text, and its two bits there; from disjoint parts of one 64-bit hash."""
    block = F.pmod(F.shiftrightunsigned(digest, 30), F.lit(blocks)).cast("int")
    bits = F.array(digest.bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int"), F.shiftrightunsigned(digest, 15).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int"))
    return block, bits


def repeated_bits(texts: DataFrame, digest: str, blocks: int) -> DataFrame:
    """(block, map): per block the bits that were set at least twice, 4 KB a block."""
    block, bits = _positions(F.col(digest), blocks)
    bit = texts.select(block.alias("block"), F.explode(F.array_distinct(bits)).alias("bit"))
    often = bit.groupBy("block", "bit").agg(F.count("*").alias("n")).filter("n > 1")
    return often.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("map"))


def _bit_of(bitmap: Column, bit: Column) -> Column:
    """Bit of a bitmap, where byte k holds bits 8k to 8k+7 from the lowest up."""
    byte = F.conv(F.hex(F.call_function("substring", bitmap, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, bit % 8).bitwiseAND(F.lit(1)) == 1


def mark_copies(df: DataFrame, doc_id: str, text: str, filter_bytes: int = 256 << 20, bits_per_row: int = 16) -> tuple[DataFrame, str]:
    """``df`` with one more struct column (its name is returned): keep_id, group_size, kept, text_sha256.

    Texts are equal when equal without blanks; null is the empty text. Of equal texts the
    row with the most code points in the original stays, then the smallest doc_id (a null
    id comes last), and of rows equal in both exactly one. Unique rows don't shuffle.
    The filter takes ``bits_per_row`` bits a row up to ``filter_bytes``, which also bounds
    the broadcast; a fuller filter sends more unique rows through the shuffle and changes
    no row. An empty table gives no rows.
    """
    digest, mark = free_name(df, "_digest"), free_name(df, "copies")
    hashed = df.withColumn(digest, F.xxhash64(without_blanks(col(df, text))))
    rows = df.count()
    blocks = max(1, min(rows * bits_per_row // BLOCK_BITS + 1, filter_bytes // (BLOCK_BITS // 8)))
    maps = saved(repeated_bits(hashed.select(digest), digest, blocks), "bloom")
    block, bits = _positions(F.col(digest), blocks)
    b, m, tested = free_name(df, "_block"), free_name(df, "_map"), free_name(df, "_twice")
    side = F.broadcast(maps.select(F.col("block").alias(b), F.col("map").alias(m)))  # at most filter_bytes
    twice = F.coalesce(_bit_of(F.col(m), bits[0]) & _bit_of(F.col(m), bits[1]), F.lit(False))
    flagged = hashed.withColumn(b, block).join(side, b, "left").withColumn(tested, twice).drop(b, m)

    n, sha, row, group, first, size = (free_name(df, x) for x in ("_points", "_sha", "_row", "_group", "_first", "_size"))
    own = F.sha2(without_blanks(col(df, text)), 256)
    single = flagged.filter(~F.col(tested)).withColumn(
        mark,
        F.struct(col(df, doc_id).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), own.alias("text_sha256")),
    ).select(*[f"`{c}`" for c in df.columns], mark)
    again = saved(
        flagged.filter(F.col(tested)).drop(tested, digest).withColumn(n, F.char_length(F.coalesce(col(df, text), F.lit(""))))
        .withColumn(sha, own).withColumn(row, F.monotonically_increasing_id()),
        "possible-copies",
    )
    best = F.min(F.struct((-F.col(n)).alias("n"), col(again, doc_id).isNull().alias("none"), col(again, doc_id).alias("id"), F.col(row).alias("row")))
    groups = saved(again.groupBy(F.col(sha).alias(group)).agg(best.alias(first), F.count("*").alias(size)), "copy-groups")
    joined = again.join(groups, again[sha] == F.col(group))
    marked = joined.withColumn(
        mark,
        F.struct(
            F.col(first)["id"].alias("keep_id"), F.col(size).alias("group_size"),
            (F.col(row) == F.col(first)["row"]).alias("kept"), F.col(sha).alias("text_sha256"),
        ),
    ).select(*[f"`{c}`" for c in df.columns], mark)
    return single.unionByName(marked), mark


def drop_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with its columns."""
    marked, mark = mark_copies(df, doc_id, text)
    return marked.filter(F.col(mark)["kept"]).drop(mark)
