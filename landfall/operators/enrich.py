"""Null cleanse, lineage columns and the warehouse column list."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from landfall.contract import Contract
from landfall.functions.sql import col, lit
from landfall.functions.text import blank_null_word, replace_inner_null_tokens
from landfall.operators.quality import kinds_of, text_of

# A pipe in the raw text, or the beginning of its JSON or XML escape.
MAY_HOLD_PIPE = f"(contains(_raw, '|') OR contains(_raw, {lit(chr(92) + 'u007')}) OR contains(_raw, '&#'))"
LINEAGE = ("ingestion_timestamp", "execution_id", "source_creation_time")


def _cleansed(c: str, kind: T.DataType, clean: Callable[[str], str], depth: int = 0) -> str:
    """The value with every text in it cleansed, at any depth; unchanged if its type holds none."""
    if isinstance(kind, T.StringType):
        return clean(c)
    if isinstance(kind, T.VariantType):
        # Pipes occur in JSON only within texts, and so do the tokens between them.
        text = f"to_json({c})"
        return f"CASE WHEN contains({text}, '|') THEN parse_json({clean(text)}) ELSE {c} END"
    x = f"x{depth}"
    if isinstance(kind, T.ArrayType):
        inner = _cleansed(x, kind.elementType, clean, depth + 1)
        return c if inner == x else f"transform({c}, {x} -> {inner})"
    if isinstance(kind, T.MapType):
        inner = _cleansed(x, kind.valueType, clean, depth + 1)
        return c if inner == x else f"transform_values({c}, (k{depth}, {x}) -> {inner})"
    if isinstance(kind, T.StructType):
        members = {m.name: (f"{c}.{col(m.name)}", m.dataType) for m in kind.fields}
        inner = {n: _cleansed(v, k, clean, depth) for n, (v, k) in members.items()}
        if all(inner[n] == v for n, (v, _) in members.items()):
            return c
        return f"if({c} IS NULL, NULL, named_struct({', '.join(f'{lit(n)}, {v}' for n, v in inner.items())}))"
    return c


def cleanse_nulls(df: DataFrame, columns: list[str], whole_words: bool = False) -> DataFrame:
    """Blank out null tokens between pipes inside text values, nested ones too; on
    request, also values that are nothing but a null word.

    Plain texts go through one lambda as an array, and only for rows whose raw
    text may hold a pipe at all, so the compiled code does not grow with the contract.
    """
    kinds = {n: k for n, k in kinds_of(df).items() if n in columns}
    texts = {n: col(n) for n, k in kinds.items() if isinstance(k, T.StringType)}
    wraps = [n for n, k in kinds.items() if isinstance(k, T.StructType) and k.fieldNames() == ["raw"]]
    texts |= {n: f"{col(n)}.raw" for n in wraps}

    def clean(c: str) -> str:
        tokens = replace_inner_null_tokens(c)
        return blank_null_word(f"({tokens})") if whole_words else tokens

    nested = {n: _cleansed(col(n), k, clean) for n, k in kinds.items() if n not in texts}
    nested = {n: e for n, e in nested.items() if e != col(n)}
    if not texts and not nested:
        return df
    guard = MAY_HOLD_PIPE if "_raw" in df.columns and not whole_words else "true"
    places = list(texts)

    def cleansed(name: str) -> str:
        c = col(name)
        if name in nested:
            return f"CASE WHEN {guard} THEN {nested[name]} ELSE {c} END"
        if name not in texts:
            return c
        value = f"get(_clean, {places.index(name)})"
        if name in wraps:
            value = f"if({c} IS NULL, NULL, named_struct('raw', {value}))"
        return f"if(_clean IS NULL, {c}, {value})"

    cells = f"transform(array({', '.join(texts.values())}), x -> {clean('x')})" if texts else "NULL"
    return df.selectExpr("*", f"CASE WHEN {guard} THEN {cells} END AS _clean").selectExpr(
        *[f"{cleansed(n)} AS {col(n)}" for n in df.columns]
    )


def stamp(
    df: DataFrame, execution_id: str | Column, ingestion_ts: datetime | Column, source_ts: datetime | Column
) -> DataFrame:
    """Lineage columns. Literals are fixed by the caller once per run, never drawn per row."""
    run, at, made = (
        v if isinstance(v, Column) else F.lit(v) for v in (execution_id, ingestion_ts, source_ts)
    )
    return df.withColumns(
        {"ingestion_timestamp": at, "execution_id": F.coalesce(run, F.lit(" ")), "source_creation_time": made}
    )


def warehouse_names(contract: Contract) -> list[str]:
    """Plain fields, then encrypted ones under their warehouse name."""
    return [f.warehouse_name for f in [*(f for f in contract.fields if not f.encrypt), *contract.encrypted]]


def warehouse_texts(df: DataFrame, contract: Contract) -> dict[str, str]:
    """Each warehouse column as text; null is one blank."""
    kinds = kinds_of(df)
    fields = [*(f for f in contract.fields if not f.encrypt), *contract.encrypted]
    return {f.warehouse_name: f"coalesce({text_of(col(f.name), kinds[f.name])}, ' ')" for f in fields}


def warehouse_projection(df: DataFrame, contract: Contract) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {col(n)}" for n, e in warehouse_texts(df, contract).items()], *LINEAGE)
