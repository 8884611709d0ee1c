"""Size-bounded splitting of large files into parts, and the manifest of the parts.

Nothing is shuffled for line- or chunk-separable input: the scan itself cuts the
file into ranges of the target size and each range is written as one part. Small parts of
XML and JSON arrays are put together in tasks that read ranges of the usual size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.contract import Contract
from landfall.functions.sql import lit
from landfall.functions.text import replace_pattern
from landfall.sources.delimited import drop_header, header_start
from landfall.sources.feed import is_whole_document, separator_of
from landfall.sources.json_arrays import json_arrays
from landfall.sources.json_records import json_chunks, json_lines
from landfall.sources.markup import xml_elements
from landfall.sources.quoted import quoted_records
from landfall.sources.scan import file_sizes, scan_text

# Sizes that apply when the caller states none. On a cluster,
# state a target near the block size of the storage instead.
THRESHOLD_KB = 5120
TARGET_KB = 1024
#: Parts of XML and JSON arrays up to this size are put together in tasks that read many of them.
PACKED_KB = 16384


def needs_split(length: str, threshold_kb: int = THRESHOLD_KB) -> str:
    """Whole kilobytes above the threshold; a file that is not there has no length."""
    return f"coalesce(floor({length} / 1024) > {threshold_kb}, false)"


def part_count(length: str, target_kb: int = TARGET_KB) -> str:
    return f"greatest(1, cast({length} / 1024D / {target_kb} + 0.999D as int))"


def split_plan(spark: SparkSession, paths, threshold_kb: int = THRESHOLD_KB, target_kb: int = TARGET_KB) -> DataFrame:
    """Which files to split and into how many parts, from the listing alone."""
    return file_sizes(spark, paths).selectExpr(
        "path",
        "length",
        f"{needs_split('length', threshold_kb)} AS split",
        f"{part_count('length', target_kb)} AS parts",
    )


def _sized_session(spark: SparkSession, target_kb: int) -> SparkSession:
    """A session whose scans cut files at the target size and pack nothing together."""
    session = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        session.conf.set(name, str(target_kb * 1024))
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    return session


# The place of a row in its partition, from 0: the lower bits of its id.
PLACE = f"monotonically_increasing_id() & {(1 << 33) - 1}L"
FIRST_IN_PARTITION = f"{PLACE} = 0"


def prepend_line(rows: DataFrame, line: str, every: int | None = None) -> DataFrame:
    """A line before the ``value`` rows of each partition, or before ``every`` so many of them, and so of each part."""
    first = f"({PLACE}) % {every} = 0" if every else FIRST_IN_PARTITION
    return rows.selectExpr(f"explode(if({first}, array({lit(line)}, value), array(value))) AS value")


def _wrapper(head: str, tail: str, every: int | None):
    def wrap(batches: Iterator) -> Iterator:
        import pyarrow as pa

        line = lambda text: pa.RecordBatch.from_pydict({"value": [text]})
        held = 0  # rows since the last head
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                if not held:
                    yield line(head)
                few = batch.slice(at, every - held if every else batch.num_rows)
                yield few
                at, held = at + few.num_rows, held + few.num_rows
                if held == every:
                    yield line(tail)
                    held = 0
        if held:
            yield line(tail)

    return wrap


def wrap_partitions(rows: DataFrame, head: str, tail: str, every: int | None = None) -> DataFrame:
    """A line before and a line after the ``value`` rows of each non-empty partition, or of ``every`` so many of them.

    Which row is the last one is only known at the end of a partition, which no
    column expression can see; batches are passed through unchanged.
    """
    return rows.select("value").mapInArrow(_wrapper(head, tail, every), "value string")


def _packer(head: str | None, tail: str | None, target: int, every: int | None):
    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def part(rows: list[str]):
            text = "\n".join([*([head] if head is not None else []), *rows, *([tail] if tail is not None else [])])
            return pa.RecordBatch.from_pydict({"value": [text]})

        held, size = [], 0
        for batch in batches:
            column = batch.column(0)
            for value, n in zip(column.to_pylist(), pc.binary_length(column).to_pylist(), strict=True):
                if held and (size + (n or 0) >= target or len(held) == every):
                    yield part(held)
                    held, size = [], 0
                held.append(value or "")
                size += (n or 0) + 1
        if held:
            yield part(held)

    return pack


def pack_parts(rows: DataFrame, head: str | None, tail: str | None, target_kb: int, every: int | None = None) -> DataFrame:
    """The ``value`` rows of each partition as texts of at most the target size and ``every`` so many rows, each with its head and tail.

    A row that is larger by itself is a part.
    """
    around = sum(len(t.encode()) + 1 for t in (head, tail) if t is not None)
    return rows.select("value").mapInArrow(_packer(head, tail, max(1, target_kb * 1024 - around), every), "value string")


def _source_rows(session: SparkSession, path, contract: Contract, target_kb: int) -> DataFrame:
    one_line = replace_pattern("value", r"[\r\n]+", " ")
    if is_whole_document(contract):
        records = json_arrays(session, path, contract.policy.reject_missing)
        rows = records.selectExpr("coalesce(value, _document) AS value").selectExpr(f"{one_line} AS value")
        if target_kb <= PACKED_KB:
            return rows
        # The records are known after the parse only, so they are dealt out afterwards.
        n = file_sizes(session, path).agg(F.expr(f"sum({part_count('length', target_kb)})")).first()[0]
        return rows.repartition(int(n))
    if contract.format == "XML":
        return xml_elements(session, path, contract.row_tag, not contract.policy.reject_missing).select("value")
    if contract.format == "CSV" and contract.quote:
        return drop_header(quoted_records(session, path, contract.delimiter, contract.quote).select("value"), contract)
    lines = scan_text(session, path, line_sep=separator_of(contract)).select("value")
    if contract.format == "JSON" and contract.is_json_array:
        chunks = json_chunks(lines, contract.record_end, contract.policy.reject_missing)
        return chunks.selectExpr("coalesce(value, _document) AS value").selectExpr(f"{one_line} AS value")
    if contract.format == "JSON":
        return json_lines(lines)
    return drop_header(lines, contract) if contract.format == "CSV" else lines


def split_files(
    spark: SparkSession,
    path,
    contract: Contract,
    out_dir: str,
    target_kb: int = TARGET_KB,
    header: str | None = None,
    root_tag: str | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Write size-bounded parts under ``out_dir`` in one job and return their manifest.

    Records are copied as text, so a part parses exactly as its source does.
    Delimited parts start with the header, XML parts are wrapped in a root
    element, JSON parts are JSON lines. With ``max_rows`` no part has more rows than that:
    a task closes its file and begins the next one, header or root element included.
    """
    packed = target_kb <= PACKED_KB and (contract.format == "XML" or is_whole_document(contract))
    # Where a record begins takes several passes in Python: a task for each small part would cost more than its text.
    rows, around = _source_rows(spark if packed else _sized_session(spark, target_kb), path, contract, target_kb), 0
    if packed:
        root = contract.format == "XML" and (root_tag or contract.row_tag + "s")
        rows, around, max_rows = pack_parts(rows, *((f"<{root}>", f"</{root}>") if root else (None, None)), target_kb, max_rows), 0, 1
    elif contract.format == "CSV" and contract.has_header:
        rows, around = prepend_line(rows, header or contract.delimiter.join(contract.names), max_rows), 1
    elif contract.format == "XML":
        root = root_tag or contract.row_tag + "s"
        rows, around = wrap_partitions(rows, f"<{root}>", f"</{root}>", max_rows), 2
    rows.write.option("maxRecordsPerFile", max_rows + around if max_rows else 0).mode("overwrite").text(out_dir)
    return part_manifest(spark, out_dir, contract)


def part_manifest(spark: SparkSession, out_dir: str, contract: Contract) -> DataFrame:
    """Path, rows and bytes of each part, counted where the parts are read."""
    reader = spark.read
    is_row = "true"
    if contract.format == "XML" or contract.quote:
        sizes = file_sizes(spark, out_dir).select(F.col("path").alias("part"), F.col("length").alias("bytes"))
        if contract.quote:
            records = drop_header(quoted_records(spark, out_dir, contract.delimiter, contract.quote), contract)
        else:
            records = xml_elements(spark, out_dir, contract.row_tag, not contract.policy.reject_missing)
        counts = records.groupBy(F.col("_source_file").alias("part")).agg(F.count("*").alias("rows"))
        return sizes.join(counts, "part", "left").na.fill(0, ["rows"])
    if contract.format == "CSV" and contract.has_header:
        is_row = f"NOT (startswith(value, {header_start(contract)}) OR value = {lit(contract.delimiter.join(contract.names))})"
    return (
        reader.text(out_dir)
        .selectExpr("_metadata.file_path AS part", "_metadata.file_size AS bytes", f"{is_row} AS is_row")
        .groupBy("part", "bytes")
        .agg(F.expr("count_if(is_row) AS rows"))
    )


def manifest_totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.expr("coalesce(sum(rows), 0) AS total_rows"),
        F.expr("count(part) AS part_count"),
        F.expr("round(sum(bytes) / 1024, 2) AS total_kb"),
    )
