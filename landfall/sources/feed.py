"""One entry point for all formats: paths and a contract in, parsed rows out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from landfall.contract import Contract, check_format
from landfall.sources.delimited import parse_delimited
from landfall.sources.fixed_width import parse_fixed_width
from landfall.sources.json_arrays import json_arrays
from landfall.sources.json_records import json_chunks, json_lines, parse_json_records
from landfall.sources.markup import xml_elements
from landfall.sources.quoted import quoted_records
from landfall.sources.scan import scan_text
from landfall.sources.xml_rows import chunks_of_documents, parse_xml_fragments, row_fragments


def parse_feed(lines: DataFrame, contract: Contract) -> DataFrame:
    """Parse a batch of ``value`` lines, or chunks as cut by ``separator_of``; for XML, documents."""
    fmt = check_format(contract.format)
    if fmt == "CSV":
        return parse_delimited(lines, contract)
    if fmt == "FIXEDWIDTH":
        return parse_fixed_width(lines, contract)
    if fmt == "JSON":
        if contract.is_json_array and contract.record_end:
            return parse_json_records(json_chunks(lines, contract.record_end, contract.policy.reject_missing), contract)
        return parse_json_records(json_lines(lines), contract)
    fragments = row_fragments(chunks_of_documents(lines, contract.row_tag), contract.row_tag, keep_unclosed=contract.policy.reject_missing)
    return parse_xml_fragments(fragments, contract)


def separator_of(contract: Contract) -> str | None:
    """What ends a record in the file; None for a line end."""
    if contract.format == "JSON" and contract.is_json_array and contract.record_end:
        return contract.record_end
    return None


def is_whole_document(contract: Contract) -> bool:
    """Its records are known only with all text before them."""
    return contract.format == "JSON" and contract.is_json_array and not contract.record_end


def row_elements(spark: SparkSession, paths: str | Sequence[str], contract: Contract) -> DataFrame:
    """The elements of XML files as text; read leniently, tags must be exactly as named and an unclosed last element is dropped."""
    loose = not contract.policy.reject_missing
    found = xml_elements(spark, paths, contract.row_tag, loose)
    return (found.filter("closed") if loose else found).drop("closed")


def read_feed(spark: SparkSession, paths: str | Sequence[str], contract: Contract) -> DataFrame:
    """All files of a run as one frame, whatever their number."""
    if is_whole_document(contract):
        records = json_arrays(spark, paths, keep_non_objects=contract.policy.reject_missing)
        return parse_json_records(records, contract)
    if contract.format == "CSV" and contract.quote:
        return parse_delimited(quoted_records(spark, paths, contract.delimiter, contract.quote), contract)
    if contract.format == "XML":
        return parse_xml_fragments(row_elements(spark, paths, contract), contract)
    return parse_feed(scan_text(spark, paths, line_sep=separator_of(contract)), contract)
