"""Delimited text: split on the delimiter, name by position; quotes count only if the contract names them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from landfall.contract import Contract, FieldRule
from landfall.functions.errors import BLANK, PARSE, make_error
from landfall.functions.sql import array, col, lit, once
from landfall.functions.text import is_blank, split_list, split_literal, split_quoted, unbalanced, unquoted


def header_start(contract: Contract) -> str:
    return lit(contract.names[0] + contract.delimiter)


def drop_header(lines: DataFrame, contract: Contract) -> DataFrame:
    """Header lines go: the whole header by name, or, read leniently, any line that starts with the first field's name."""
    if not contract.has_header:
        return lines
    line = f"replace(value, {lit(contract.quote)}, '')" if contract.quote else "value"
    whole = f"trim(TRAILING '\\r' FROM {line}) = {lit(contract.delimiter.join(contract.names))}"
    if contract.policy.reject_overflow:
        return lines.filter(f"NOT coalesce({whole}, false)")
    return lines.filter(f"NOT coalesce({whole} OR startswith({line}, {header_start(contract)}), false)")


def _cell(part: str, rule: FieldRule) -> str:
    if rule.shape == "list":
        return split_list(part)
    if rule.shape == "object":
        return f"if({part} IS NULL, NULL, named_struct('raw', {part}))"
    return part


def _split(contract: Contract) -> str:
    if contract.quote:
        return split_quoted("value", contract.delimiter, contract.quote)
    return split_literal("value", contract.delimiter)


def parse_delimited(lines: DataFrame, contract: Contract) -> DataFrame:
    """``value`` records to contract columns; other columns are carried along.

    Values beyond the last field are kept in ``_overflow``; fields beyond the
    last value are null and listed in ``_missing``. Read strictly, a value that
    begins with a quote and holds an odd number of them makes the record an error.
    """
    n = len(contract.names)
    carried = [col(c) for c in lines.columns if c != "value"]
    split = drop_header(lines.filter("value IS NOT NULL"), contract).selectExpr(
        *carried, "value AS _raw", f"{once(_split(contract))} AS _parts"
    )
    torn = ""
    if contract.quote:
        if contract.policy.reject_overflow:
            torn = f"WHEN _torn THEN {make_error(PARSE, 'csv', reason=lit('unbalanced quote'))}"
        split = split.selectExpr(
            *carried, "_raw", f"{unquoted('_parts', contract.quote)} AS _parts", f"{unbalanced('_parts', contract.quote)} AS _torn"
        )
    surplus = f"concat(size(_parts), ' values for {n} fields')"
    too_long = f"WHEN size(_parts) > {n} THEN {make_error(PARSE, 'csv', reason=surplus)}"
    names = array([lit(x) for x in contract.names])
    return split.selectExpr(
        *carried,
        "_raw",
        *[f"{_cell(f'get(_parts, {i})', f)} AS {col(f.name)}" for i, f in enumerate(contract.fields)],
        f"CASE WHEN size(_parts) < {n} THEN slice({names}, size(_parts) + 1, {n}) END AS _missing",
        f"CASE WHEN size(_parts) > {n} THEN slice(_parts, {n + 1}, size(_parts) - {n}) END AS _overflow",
        f"CASE WHEN {is_blank('_raw')} THEN {make_error(BLANK, 'csv')} {torn} "
        f"{too_long if contract.policy.reject_overflow else ''} END AS _error",
    )
