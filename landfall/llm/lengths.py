"""Exact token counts from a histogram of encoded lengths.

Documents are encoded where they lie and aggregated by length; sums over the lengths
from the longest down then answer totals, quantiles and truncated totals for every limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.base import col, saved
from landfall.llm.tokens import encoding

#: Lengths that are summed together before the blocks are.
SPAN = 1024


def histogram(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(length, documents) over all rows; null and empty texts have length 0. An empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(tokenizer)
        for batch in batches:
            n = np.array([len(enc.ids(t.as_py())) // enc.dtype.itemsize for t in batch.column(0)], np.int64)
            length, count = np.unique(n, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length), pa.array(count.astype(np.int64))], names=["length", "documents"])

    counted = df.select(col(df, text).alias("text")).mapInArrow(run, "length long, documents long")
    return counted.groupBy("length").agg(F.sum("documents").alias("documents"))


def limits(hist: DataFrame) -> DataFrame:
    """For each length as a context limit: what lies at, above and below it.

    documents and tokens at that length; documents_over and tokens_over the limit;
    tokens_kept when every document is cut at the limit, tokens_lost by that;
    documents_total, tokens_total; quantile, the share of documents within the limit.
    """
    hist = saved(hist, "lengths")  # it is read twice; the texts are encoded once
    blocks = hist.withColumn("block", F.floor(F.col("length") / SPAN)).withColumn("tokens", F.col("length") * F.col("documents"))
    sums = blocks.groupBy("block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # a row for 1024 lengths
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = sums.select(
        "block",
        *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in "dt"],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in "dt"],
    )
    longer = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    over = lambda c, k: (F.coalesce(F.sum(c).over(longer), F.lit(0)) + F.col(f"{k}_above")).alias(f"{c}_over")
    rows = blocks.join(sums, "block").select("length", "documents", "tokens", over("documents", "d"), over("tokens", "t"), "d_all", "t_all")
    lost = F.col("tokens_over") - F.col("length") * F.col("documents_over")
    return rows.select(
        F.col("length").alias("context_limit"), "documents", "tokens", "documents_over", "tokens_over",
        (F.col("t_all") - lost).alias("tokens_kept"), lost.alias("tokens_lost"),
        F.col("d_all").alias("documents_total"), F.col("t_all").alias("tokens_total"),
        ((F.col("d_all") - F.col("documents_over")) / F.col("d_all")).alias("quantile"),
    )


def at_limits(hist: DataFrame, wanted: list[int]) -> DataFrame:
    """(context_limit, documents_over, tokens_kept) for limits that need not be lengths of the table."""
    spark = hist.sparkSession
    asked = spark.createDataFrame([(int(w),) for w in sorted(set(wanted))], "context_limit long")
    pairs = hist.select(F.explode(F.array(*[F.struct(F.lit(int(w)).cast("long").alias("w"), F.col("length"), F.col("documents")) for w in sorted(set(wanted))])).alias("x"))
    sums = pairs.groupBy(F.col("x.w").alias("w")).agg(
        F.sum(F.when(F.col("x.length") > F.col("x.w"), F.col("x.documents")).otherwise(0)).alias("documents_over"),
        F.sum(F.least("x.length", "x.w") * F.col("x.documents")).alias("tokens_kept"),
    )
    return asked.join(sums, asked.context_limit == sums.w, "left").select(
        "context_limit", F.coalesce("documents_over", F.lit(0)).alias("documents_over"), F.coalesce("tokens_kept", F.lit(0)).alias("tokens_kept")
    )
