"""Good rows one way, bad rows the other, and the text a reader gets to see."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from landfall.functions.errors import BLANK, PARSE, VALIDATION, humanize
from landfall.functions.sql import lit
from landfall.functions.text import preview


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter("_error IS NULL")


def error_rows(df: DataFrame) -> DataFrame:
    return df.filter("_error IS NOT NULL")


def outcome(error: str) -> str:
    """The name of the branch a row takes, for a write that takes both in one pass."""
    return f"if({error} IS NULL, 'valid', 'error')"


def route_counts(df: DataFrame) -> DataFrame:
    """Rows per error type and field, and good rows, in one pass."""
    return (
        df.selectExpr("coalesce(_error.type, 'valid') AS outcome", "coalesce(_error.field, '') AS field")
        .groupBy("outcome", "field")
        .agg(F.count("*").alias("n"))
    )


def is_envelope(line: str) -> str:
    """Text that carries an error marker in front."""
    return f"rlike({line}, {lit(r'^(PARSE_ERROR|VALIDATION_ERROR|ERROR|BLANK)\|')})"


def read_envelopes(df: DataFrame, line: str, into: str) -> DataFrame:
    """Error envelopes (``TYPE|...``) to a struct of type, stage, field, message and data.

    Parts are pipe-separated, so data ends at its first pipe; a marker with too
    few parts is of unknown type and its message is the whole line.
    """

    def struct(kind: str, stage: str, field: str, message: str, data: str) -> str:
        return (
            f"named_struct('type', '{kind}', 'stage', {stage}, 'field', {field}, "
            f"'message', {message}, 'data', {data})"
        )

    p = [f"get(_parts, {i})" for i in range(5)]
    parse = struct(PARSE, p[1], "''", humanize(f"'{PARSE}'", "''", p[2]), p[3])
    invalid = struct(VALIDATION, p[1], p[2], humanize(f"'{VALIDATION}'", p[2], p[3]), p[4])
    blank = struct(BLANK, "''", "''", humanize(f"'{BLANK}'", "''", "''"), p[1])
    return df.selectExpr("*", f"split({line}, '[|]', -1) AS _parts").selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"""CASE
            WHEN {p[0]} = 'PARSE_ERROR' AND size(_parts) >= 4 THEN {parse}
            WHEN {p[0]} = 'VALIDATION_ERROR' AND size(_parts) >= 5 THEN {invalid}
            WHEN {p[0]} = 'ERROR' AND size(_parts) >= 3 THEN {struct('ERROR', "''", "''", p[1], p[2])}
            WHEN {p[0]} = 'BLANK' AND size(_parts) >= 2 THEN {blank}
            ELSE {struct('UNKNOWN', "''", "''", line, "''")} END AS {into}""",
    )


def error_report(at: str, kind: str, stage: str, field: str, message: str, data: str) -> str:
    """The text block of one rejected row; lines without content are left out."""

    def line(label: str, c: str, always: bool = False) -> str:
        text = f"concat({lit(label.ljust(14) + ': ')}, {c})"
        return text if always else f"CASE WHEN coalesce({c}, '') <> '' THEN {text} END"

    # The labels and their order are the report format.
    lines = [
        line("Timestamp", at),
        line("Error Type", kind),
        line("Stage", stage),
        line("Field", field),
        line("Message", message, always=True),
        line("Data", preview(data)),
    ]
    return f"concat_ws('\\n', {', '.join(lines)})"
