"""File scans. All of them are lazy; only sizes are looked at up front."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def scan_text(
    spark: SparkSession,
    paths: str | Sequence[str],
    line_sep: str | None = None,
    whole_file: bool = False,
    extent: bool = False,
) -> DataFrame:
    """Lines (or separator-bounded chunks) of many files with their origin.

    Plain and separator-bounded scans are splittable: one large file is read
    by many tasks. ``whole_file`` gives one row, and so one task, per file.
    ``extent`` adds the size of the file and where the split that was read starts.
    """
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.text(paths if isinstance(paths, str) else list(paths), wholetext=whole_file).select(
        *scanned(extent)
    )


def scanned(extent: bool = False) -> list[Column]:
    """What a text scan gives, batch or stream."""
    origin = {"_source_file": "file_path", "_source_ts": "file_modification_time"}
    place = {"_size": "file_size", "_block": "file_block_start"} if extent else {}
    return [F.col("value"), *(F.col(f"_metadata.{m}").alias(n) for n, m in (origin | place).items())]


def file_sizes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path, size and time of each file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(paths if isinstance(paths, str) else list(paths))
        .select("path", "length", "modificationTime")
    )


def scan_raw_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return scan_text(spark, paths).select(F.col("value").alias("raw_line"))


def scan_header_csv(spark: SparkSession, paths: str | Sequence[str], contract) -> DataFrame:
    """Quote-aware scan of delimited files with a header, all columns text.

    A row with more or fewer values than fields is kept whole in ``_corrupt``.
    """
    schema = ", ".join(f"`{n}` string" for n in [*contract.names, "_corrupt"])
    return spark.read.csv(
        paths if isinstance(paths, str) else list(paths),
        schema=schema,
        sep=contract.delimiter,
        header=contract.has_header,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord="_corrupt",
        enforceSchema=True,
    )
