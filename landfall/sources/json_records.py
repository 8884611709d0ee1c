"""JSON: one record per line, whole documents, or separator-bounded chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from landfall.contract import Contract
from landfall.functions.errors import PARSE, make_error
from landfall.functions.sql import array, col, ddl, lit, once, options
from landfall.functions.text import is_blank, replace_pattern, strip_start

READ_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
MALFORMED = make_error(PARSE, "json", reason=lit("malformed JSON"))


def from_json(text: str, schema: str) -> str:
    return f"from_json({text}, {lit(schema)}, {options(READ_OPTIONS)})"


def json_lines(lines: DataFrame) -> DataFrame:
    """One document per line; blank lines are skipped."""
    return lines.filter(f"NOT {is_blank('value')}")


def json_chunks(chunks: DataFrame, record_end: str, keep_non_objects: bool = True) -> DataFrame:
    """Elements of a large array file that was scanned with ``record_end``
    (such as a newline, the element indent and a brace) as the separator.

    A chunk holds the elements since the last ``record_end``, usually one; it is
    read as an array of its own. A chunk that is none stays one null record with
    its text in ``_document``.
    """
    carried = [col(c) for c in chunks.columns if c != "value"]
    body = replace_pattern("value", r"^[\x00-\x20]*[,\[]?")  # the comma after the last element, or the opening bracket
    whole = f"concat('[', _body, {lit(record_end)}, ']')"
    rows = chunks.selectExpr(*carried, f"{body} AS _body").selectExpr(
        *carried, "_body", f"{once(from_json(whole, 'array<string>'))} AS _records"
    ).selectExpr(
        *carried,
        f"CASE WHEN _records IS NULL THEN concat(_body, {lit(record_end)}) END AS _document",
        "explode(coalesce(_records, array(cast(NULL as string)))) AS value",
    )
    return rows if keep_non_objects else rows.filter("value IS NULL OR startswith(value, '{')")


def _document_records(doc: str) -> str:
    """Elements of an array, one object, or the lines of JSON-lines text; null if none of these."""
    start = f"substring({strip_start(doc)}, 1, 1)"
    lines = f"filter(split({doc}, {lit(r'\r?\n')}, -1), l -> NOT {is_blank('l')})"
    wrapped = f"concat('[', {doc}, ']')"
    objects_only = f"forall({lines}, l -> startswith({strip_start('l')}, '{{'))"
    return f"""CASE {start}
        WHEN '[' THEN {from_json(doc, 'array<string>')}
        WHEN '{{' THEN coalesce(
            {from_json(wrapped, 'array<string>')}, CASE WHEN {objects_only} THEN {lines} END)
        ELSE CASE WHEN {is_blank(doc)} THEN cast(array() as array<string>) END END"""


def json_documents(docs: DataFrame, keep_non_objects: bool = True) -> DataFrame:
    """Whole documents to records. A malformed document stays one null record
    with its text in ``_document``, so that it turns into one error row."""
    carried = [col(c) for c in docs.columns if c != "value"]
    rows = docs.selectExpr(*carried, "value", f"{once(_document_records('value'))} AS _records").selectExpr(
        *carried,
        "CASE WHEN _records IS NULL THEN value END AS _document",
        "explode(coalesce(_records, array(cast(NULL as string)))) AS value",
    )
    return rows if keep_non_objects else rows.filter("value IS NULL OR startswith(value, '{')")


def _numbers_as_text(name: str, c: str) -> str:
    """A variant whose numbers are spelt as in a plain field; only records that hold one are parsed again."""
    text = f"{from_json('_raw', ddl({name: 'string'}))}.{col(name)}"
    return f"CASE WHEN rlike(schema_of_variant({c}), '^(BIGINT|DECIMAL|DOUBLE|FLOAT)') THEN cast({text} as variant) ELSE {c} END"


def parse_json_records(records: DataFrame, contract: Contract) -> DataFrame:
    """``value`` documents to contract columns in one parse.

    Fields are text (nested values as JSON text); fields to be encrypted are
    variants, since what is encrypted depends on the value's own shape. A number
    among them is the text that a plain field would hold. Text after the document
    is an error; read leniently, it is ignored.
    """
    carried = [col(c) for c in records.columns if c not in ("value", "_document")]
    raw = "coalesce(value, _document)" if "_document" in records.columns else "value"
    kinds = {f.name: "variant" if f.encrypt == "value" else "string" for f in contract.fields}
    if contract.policy.reject_overflow:
        listed = from_json("concat('[', value, ']')", f"array<struct<{ddl(kinds)}>>")
        record = f"transform(array({listed}), r -> if(size(r) = 1, r[0], NULL))[0]"
        corrupt = "false"
    else:
        record = from_json("value", ddl(kinds | {"_corrupt": "string"}))
        corrupt = "_rec._corrupt IS NOT NULL"
    fields = {n: f"_rec.{col(n)}" for n in contract.names}
    values = {n: _numbers_as_text(n, c) if kinds[n] == "variant" else c for n, c in fields.items()}
    bad = f"(_rec IS NULL OR {corrupt})"
    # The keys are only listed for rows with some null field.
    some_null = " OR ".join(f"{c} IS NULL" for c in fields.values())
    names = array([lit(n) for n in contract.names])
    absent = f"array_except({names}, coalesce(json_object_keys(_raw), {array([])}))"
    return records.selectExpr(*carried, f"{raw} AS _raw", f"{once(record)} AS _rec").selectExpr(
        *carried,
        "_raw",
        *[f"{c} AS {col(n)}" for n, c in values.items()],
        f"CASE WHEN NOT {bad} AND ({some_null}) THEN {absent} END AS _missing",
        f"CASE WHEN {bad} THEN {MALFORMED} END AS _error",
    )
