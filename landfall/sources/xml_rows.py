"""XML rows: the text from each opening row tag to the next closing one, of documents that are rows already; and their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from landfall.contract import Contract
from landfall.functions.errors import PARSE, make_error
from landfall.functions.sql import col, ddl, lit, once, options
from landfall.functions.text import split_literal

READ_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    "ignoreSurroundingSpaces": "false",
    "nullValue": "\u0001",
}
MALFORMED = make_error(PARSE, "xml", reason=lit("malformed XML"))
FLAT_SHAPES = ("text", "list", "object")


def chunk_separator(row_tag: str) -> str:
    return f"</{row_tag}>"


def holds_row(row_tag: str) -> str:
    return f"contains(value, {lit(f'<{row_tag}>')})"


def chunks_of_documents(docs: DataFrame, row_tag: str) -> DataFrame:
    """The same chunks for documents that are already rows."""
    carried = [col(c) for c in docs.columns if c != "value"]
    cut = docs.selectExpr(*carried, f"{split_literal('value', chunk_separator(row_tag))} AS _cut")
    named = "transform(_cut, (c, i) -> named_struct('value', c, '_closed', i < size(_cut) - 1))"
    return cut.selectExpr(*carried, f"inline({named})")


def row_fragments(chunks: DataFrame, row_tag: str, keep_unclosed: bool = False) -> DataFrame:
    """One fragment per row element; chunks without an opening tag hold none."""
    carried = [col(c) for c in chunks.columns if c not in ("value", "_closed")]
    rows = chunks.filter(holds_row(row_tag))
    if not keep_unclosed:
        rows = rows.filter("_closed")
    fragment = f"substring(value, locate({lit(f'<{row_tag}>')}, value))"
    tail = f"if(_closed, {lit(chunk_separator(row_tag))}, '')"
    return rows.selectExpr(*carried, f"concat({fragment}, {tail}) AS value")


def parse_xml_fragments(fragments: DataFrame, contract: Contract) -> DataFrame:
    """``value`` fragments to contract columns: text, or the declared nested shape."""
    carried = [col(c) for c in fragments.columns if c != "value"]
    kinds = {f.name: "string" if f.shape in FLAT_SHAPES else f.shape for f in contract.fields}
    schema = ddl(kinds | {"_corrupt": "string"})
    fields = {n: f"_rec.{col(n)}" for n in contract.names}
    bad = "(_rec IS NULL OR _rec._corrupt IS NOT NULL)"
    some_null = " OR ".join(f"{c} IS NULL" for c in fields.values())
    absent = ", ".join(f"CASE WHEN {c} IS NULL THEN {lit(n)} END" for n, c in fields.items())
    return fragments.selectExpr(
        *carried, "value AS _raw", f"{once(f'from_xml(value, {lit(schema)}, {options(READ_OPTIONS)})')} AS _rec"
    ).selectExpr(
        *carried,
        "_raw",
        *[f"{c} AS {col(n)}" for n, c in fields.items()],
        f"CASE WHEN NOT {bad} AND ({some_null}) THEN array_compact(array({absent})) END AS _missing",
        f"CASE WHEN {bad} THEN {MALFORMED} END AS _error",
    )
