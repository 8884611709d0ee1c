"""Column protection, driven by the contract and by each column's type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from landfall.contract import Contract, FieldRule
from landfall.functions import crypto
from landfall.functions.sql import col
from landfall.operators.quality import kinds_of

MEMBER = "phone"


def sealed(c: str, kind: T.DataType, rule: FieldRule, strict: bool) -> str:
    """The protected form of one field; needs the key column."""
    if isinstance(kind, T.VariantType):
        return crypto.encrypt_variant(c, MEMBER, whole=strict and rule.encrypt == "value")
    if isinstance(kind, T.StructType):
        members = kind.fieldNames()
        if MEMBER in members:
            return crypto.encrypt_member(c, kind, MEMBER)
        # A wrapped text of unknown shape has no phone member to single out.
        if strict and members == ["raw"]:
            return crypto.encrypt_member(c, kind, "raw")
        return crypto.encrypt_text(f"to_json({c})") if strict else c
    if isinstance(kind, T.ArrayType):
        nested = isinstance(kind.elementType, T.StructType) and MEMBER in kind.elementType.fieldNames()
        if nested:
            return crypto.encrypt_members(c, kind, MEMBER)
        return crypto.encrypt_text(f"to_json({c})") if strict else c
    if rule.encrypt == "phone":
        return crypto.encrypt_json_text(c, MEMBER)
    return crypto.encrypt_text(c)


def encrypt_columns(df: DataFrame, contract: Contract, key: Column | None) -> DataFrame:
    """Encrypt the contract's fields on good rows; bad rows lose them. No such field, no change."""
    rules = contract.encrypted
    if not rules:
        return df
    if key is None:
        raise crypto.KeyProblem("the contract encrypts fields but no AES key was given")
    kinds = kinds_of(df)
    good = "_error IS NULL" if "_error" in df.columns else "true"
    strict = contract.policy.empty_nested_is_blank
    edits = {
        f.name: F.expr(f"CASE WHEN {good} THEN {sealed(col(f.name), kinds[f.name], f, strict)} END") for f in rules
    }
    return crypto.with_key(df, key, lambda keyed: keyed.withColumns(edits))


def decrypt_columns(df: DataFrame, columns: list[str], key: Column, damaged_to_null: bool = False) -> DataFrame:
    """The inverse for text columns, wherever they are stored."""
    read = crypto.try_decrypt_text if damaged_to_null else crypto.decrypt_text
    edits = {c: F.expr(read(col(c))) for c in columns}
    return crypto.with_key(df, key, lambda keyed: keyed.withColumns(edits))
