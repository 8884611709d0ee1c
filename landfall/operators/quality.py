"""Quality rules. All of them fold into one ``_error`` column; the first one wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from landfall.contract import Contract, FieldRule, Policy
from landfall.functions.crypto import variant_text
from landfall.functions.errors import BLANK, NO_ERROR, VALIDATION, make_error
from landfall.functions.sql import array, col, lit, once
from landfall.functions.text import is_blank, utf16_length

STAGE = "warehouse"

#: Up to so many rules, a compiled check stands before the lambda, which is interpreted. Beyond, compiling it would cost more.
COMPILED = 16


def kinds_of(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def text_of(c: str, kind: T.DataType) -> str:
    """The stored text of a value: scalars as they are, nested values as JSON."""
    if isinstance(kind, T.VariantType):
        return variant_text(c)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return f"to_json({c})"
    return c if isinstance(kind, T.StringType) else f"cast({c} as string)"


def is_null(c: str, kind: T.DataType) -> str:
    if isinstance(kind, T.VariantType):
        return f"({c} IS NULL OR is_variant_null({c}))"
    return f"({c} IS NULL)"


def is_empty(c: str, kind: T.DataType, look_inside: bool) -> str:
    """Nothing but blanks. Lists and objects only count as empty when ``look_inside``."""
    if isinstance(kind, T.StringType):
        empty = is_blank(c)
    elif isinstance(kind, T.VariantType):
        empty = is_blank(variant_text(c))
    elif not look_inside:
        return "false"
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        empty = f"forall({c}, x -> coalesce({is_blank('x')}, true))"
    elif isinstance(kind, T.StructType) and all(isinstance(m.dataType, T.StringType) for m in kind.fields):
        texts = ", ".join(f"{c}.{col(m)}" for m in kind.fieldNames())
        empty = is_blank(f"concat_ws('', {texts})")
    else:
        return "false"
    return f"coalesce({empty}, false)"


def _cell(name: str, kind: T.DataType, look_inside: bool) -> str:
    """A text that is null, blank or filled just as the value is."""
    c = col(name)
    if isinstance(kind, T.StringType):
        return c
    return f"CASE WHEN {is_null(c, kind)} THEN NULL WHEN {is_empty(c, kind, look_inside)} THEN '' ELSE 'x' END"


def _cells(df: DataFrame, rules: list[FieldRule], policy: Policy) -> str:
    kinds = kinds_of(df)
    return "array(" + ", ".join(_cell(f.name, kinds[f.name], policy.empty_nested_is_blank) for f in rules) + ")"


def _names(rules: list[FieldRule]) -> str:
    return array([lit(f.name) for f in rules])


def blank_row(df: DataFrame, contract: Contract) -> str:
    """Every required field (every field, if none is required) is missing, null or empty.

    The first field is looked at on its own: where it is filled, as it mostly
    is, no array is built.
    """
    rules = contract.required
    if not rules:
        if not contract.policy.empty_nested_is_blank:
            return "true"
        rules = list(contract.fields)
    first = _cell(rules[0].name, kinds_of(df)[rules[0].name], contract.policy.empty_nested_is_blank)
    rest = f"forall({_cells(df, rules, contract.policy)}, x -> x IS NULL OR {is_blank('x')})"
    return f"(({first}) IS NULL OR {is_blank(f'({first})')}) AND {rest}"


def required_error(df: DataFrame, contract: Contract) -> str:
    """The first required field, in contract order, that is missing, null or empty.

    The fields go through one lambda as an array, so neither the plan nor the
    compiled code grows with their number.
    """
    rules = contract.required
    if not rules:
        return NO_ERROR
    cells, names = _cells(df, rules, contract.policy), _names(rules)
    listed = f"coalesce(array_contains(_missing, get({names}, i)), false)"
    if contract.policy.reject_missing:
        reason = f"CASE WHEN x IS NULL THEN if({listed}, 'missing', 'null') WHEN {is_blank('x')} THEN 'empty' END"
    else:
        reason = f"CASE WHEN x IS NULL THEN if({listed}, NULL, 'null') WHEN {is_blank('x')} THEN 'empty' END"
    broken = f"exists({cells}, x -> x IS NULL OR {is_blank('x')})"
    if len(rules) <= COMPILED:  # a null or blank cell is below '!'
        kinds, look_inside = kinds_of(df), contract.policy.empty_nested_is_blank
        lowest = ", ".join(f"coalesce({_cell(f.name, kinds[f.name], look_inside)}, '')" for f in rules)
        broken = f"least('!', {lowest}) < '!' AND {broken}"
    found = _first_found(f"transform({cells}, (x, i) -> {reason})", names)
    return f"CASE WHEN {broken} THEN {found} END"


def _first_found(reasons: str, names: str) -> str:
    """The error of the first non-null reason in a list that is parallel to ``names``."""
    listed = (
        f"filter(transform({reasons}, (r, i) -> named_struct('type', '{VALIDATION}', 'stage', '{STAGE}', "
        f"'field', get({names}, i), 'reason', r)), e -> e.reason IS NOT NULL)"
    )
    return f"get({listed}, 0)"


def length_error(df: DataFrame, contract: Contract) -> str:
    """The first value, in contract order, that is shorter or longer than its field allows; null has no length that does."""
    rules = [f for f in contract.fields if f.min_length is not None or f.max_length is not None]
    if not rules or not contract.policy.check_lengths:
        return NO_ERROR
    kinds = kinds_of(df)
    texts = "array(" + ", ".join(text_of(col(f.name), kinds[f.name]) for f in rules) + ")"
    names = _names(rules)
    top = 2**31 - 1
    low = "get(array(" + ", ".join(str(f.min_length or 0) for f in rules) + "), i)"
    high = "get(array(" + ", ".join(str(top if f.max_length is None else f.max_length) for f in rules) + "), i)"
    size = utf16_length("x")
    outside = f"coalesce(NOT {size} BETWEEN {low} AND {high}, true)"
    limit = f"if({high} = {top}, '', cast({high} as string))"
    reason = f"CASE WHEN {outside} THEN concat('length ', coalesce(cast({size} as string), 'of null'), ' outside ', {low}, '..', {limit}) END"
    broken = f"exists(transform({texts}, (x, i) -> {outside}), b -> b)"
    if len(rules) <= COMPILED and all(isinstance(kinds[f.name], T.StringType) for f in rules):
        # A unit is one to three bytes, so a text of that many bytes is surely inside.
        inside = " AND ".join(
            f"coalesce(octet_length({col(f.name)}) BETWEEN {3 * f.min_length - 2 if f.min_length else 0} "
            f"AND {top if f.max_length is None else f.max_length}, false)"
            for f in rules
        )
        broken = f"NOT ({inside}) AND {broken}"
    return f"CASE WHEN {broken} THEN {_first_found(f'transform({texts}, (x, i) -> {reason})', names)} END"


def _rule_cases(c: str, rule: FieldRule) -> list[tuple[str, str]]:
    """(broken, reason) of the storage, type and pattern rules about one value."""
    cases = []
    if rule.not_null:
        cases.append((f"{c} IS NULL", lit("null in a NOT NULL column")))
    if rule.width is not None:
        cases.append((f"length({c}) > {rule.width}", lit(f"longer than VARCHAR({rule.width})")))
    if rule.allowed:
        values = ", ".join(lit(v) for v in rule.allowed)
        cases.append((f"{c} NOT IN ({values})", lit("not one of " + "/".join(rule.allowed))))
    filled = f"NOT {is_blank(c)}"
    if rule.type:
        cases.append((f"{filled} AND try_cast({c} as {rule.type}) IS NULL", lit(f"not a {rule.type}")))
    if rule.pattern:
        cases.append((f"{filled} AND NOT rlike({c}, {lit(rule.pattern)})", lit("does not match the pattern")))
    return cases


def value_error(df: DataFrame, contract: Contract) -> str:
    """The first storage, type or pattern rule, in contract order, that a value breaks."""
    kinds = kinds_of(df)
    cases = [
        f"WHEN {broken} THEN {make_error(VALIDATION, STAGE, f.name, reason)}"
        for f in contract.fields
        for broken, reason in _rule_cases(text_of(col(f.name), kinds[f.name]), f)
    ]
    return f"CASE {' '.join(cases)} END" if cases else NO_ERROR


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """Parsed rows with ``_error`` completed. The first one wins: parse errors,
    blank rows, required fields, lengths, then the other rules by field.

    All checks are one projection, so each row is copied once. The lambdas in it
    keep it out of whole-stage code, which would make it a single method too
    large for the JVM to compile to machine code; a plain projection is split.
    """
    blank = f"CASE WHEN {blank_row(df, contract)} THEN {make_error(BLANK, STAGE)} END"
    rules = [rule(df, contract) for rule in (required_error, length_error, value_error)]
    checks = ", ".join(["_error", blank, *rules])
    return df.withColumn("_error", F.expr(once(f"coalesce({checks})")))
