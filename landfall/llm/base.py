"""What the operators share: tables, saved frames, document keys and free column names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.plans.workspace import shared_dir

#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\\x20\\x09-\\x0D"


#: Bytes of an Arrow batch on its way to a Python worker, where the session does not state its own limit.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """From now on this session sends texts to Python workers a few megabytes at a time, however long they are.

    What a worker and its executor hold for a batch is several times its size. A limit that
    was set before is left alone.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if limit not in spark.conf.getAll:
        spark.conf.set(limit, str(BATCH_BYTES))


def saved(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends here, and a lost executor costs no recomputation."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_memories: dict[str, Callable[[], None]] = {}


def remember(kind: str, forget: Callable[[], None]) -> None:
    """A task of this kind begins in this Python worker: what tasks of other kinds have left in memory goes."""
    for other in [k for k in _memories if k != kind]:
        _memories.pop(other)()
    _memories[kind] = forget


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, made longer until ``df`` has no such column (names are compared as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def col(df: DataFrame, name: str) -> Column:
    return df["`" + name.replace("`", "``") + "`"]


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; null ids are in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def document_key(doc_id: Column, text: Column) -> list[Column]:
    """Id and text hash: tells apart rows that share an id by mistake."""
    return [doc_id.alias("doc_id"), F.xxhash64(text).alias("text_key")]


def without(docs: DataFrame, losers: DataFrame, doc_id: str, text: str, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows whose (doc_id, text_key) is in ``losers``; null ids match null ids.

    ``losers`` is counted first and broadcast only up to ``broadcast_rows`` (16 bytes each);
    beyond that both sides are joined by key. The rows are the same.
    """
    gone_id, gone_key = free_name(docs, "_gone_id"), free_name(docs, "_gone_key")
    gone = losers.select(F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key))
    if gone.count() <= broadcast_rows:
        gone = F.broadcast(gone)
    same = col(docs, doc_id).eqNullSafe(F.col(gone_id)) & (F.xxhash64(col(docs, text)) == F.col(gone_key))
    return docs.join(gone, same, "left_anti")
