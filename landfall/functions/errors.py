"""The ``_error`` column: a struct that is null on a good row."""

from __future__ import annotations

from landfall.functions.sql import lit

ERROR_TYPE = "struct<type:string,stage:string,field:string,reason:string>"

PARSE = "PARSE_ERROR"
VALIDATION = "VALIDATION_ERROR"
BLANK = "BLANK_ROW"

NO_ERROR = f"cast(NULL as {ERROR_TYPE})"


def make_error(kind: str, stage: str = "", field: str = "", reason: str = "''") -> str:
    """``reason`` is an expression, the rest are texts."""
    return f"named_struct('type', {lit(kind)}, 'stage', {lit(stage)}, 'field', {lit(field)}, 'reason', {reason})"


def humanize(kind: str, field: str, reason: str) -> str:
    """The sentence a reader of the error report sees."""
    # The sentences and the prefix are part of the report format.
    unreadable = "json_parse_failed:"
    return f"""CASE
        WHEN {kind} = '{BLANK}' THEN 'Row is empty - all required fields are blank'
        WHEN {kind} = '{PARSE}' THEN concat('Could not parse the row: ', {reason})
        WHEN coalesce({field}, '') = '' THEN concat('Validation failed: ', {reason})
        WHEN {reason} = 'empty' THEN concat('Required field \\'', {field}, '\\' is empty - cannot be blank')
        WHEN {reason} = 'null' THEN concat('Required field \\'', {field}, '\\' is null')
        WHEN startswith({reason}, '{unreadable}')
            THEN concat('Row is not valid JSON: ', substring({reason}, {len(unreadable) + 1}))
        ELSE concat('Field \\'', {field}, '\\' validation failed: ', {reason}) END"""
