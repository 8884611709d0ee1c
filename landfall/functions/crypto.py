"""AES-GCM expressions. Layout: Base64(12-byte IV, ciphertext, 16-byte tag).

Each evaluation draws a fresh IV, so ciphertext must be written once and never
recomputed. The key reaches executors as a one-row scalar subquery: its bytes
are in no literal, and so in no plan text, explain output or event log.
Expressions name the key by its column, see ``with_key``.
"""

from __future__ import annotations

import base64
import binascii
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, types as T

from landfall.functions.sql import col, lit

KEY_SIZES = (16, 24, 32)
KEY = "_aes_key"


class KeyProblem(ValueError):
    """The key cannot be used; nothing is encrypted."""


def key_column(spark: SparkSession, base64_key: str | None) -> Column:
    """The checked key as a column that any frame of the session can use."""
    if not base64_key or not base64_key.strip():
        raise KeyProblem("an AES key is required (Base64 of 16, 24 or 32 bytes)")
    try:
        raw = base64.b64decode(base64_key, validate=True)
    except binascii.Error as e:
        raise KeyProblem("the AES key is not Base64") from e
    if len(raw) not in KEY_SIZES:
        raise KeyProblem(f"the AES key must decode to 16, 24 or 32 bytes, got {len(raw)}")
    return spark.createDataFrame([(bytearray(raw),)], "key binary").scalar()


def with_key(df: DataFrame, key: Column, edit: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``edit`` a frame that has the key as a column for as long as the edit lasts."""
    return edit(df.withColumn(KEY, key)).drop(KEY)


def _seal(text: str) -> str:
    # base64() may break its result into lines of 76 characters.
    line_break = lit("\r\n")
    return f"replace(base64(aes_encrypt({text}, {KEY}, 'GCM')), {line_break}, '')"


def encrypt_text(c: str) -> str:
    """Null stays null and '' stays ''; blanks are encrypted like any text."""
    return f"CASE WHEN {c} = '' THEN {c} ELSE {_seal(c)} END"


def decrypt_text(c: str) -> str:
    """Null and blanks (as absent values are landed) give one blank; a value that is not ours fails the job."""
    return (
        f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN ' ' "
        f"ELSE cast(aes_decrypt(unbase64({c}), {KEY}, 'GCM') as string) END"
    )


def try_decrypt_text(c: str) -> str:
    """As decrypt_text, but a damaged value gives null."""
    return (
        f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN ' ' "
        f"ELSE cast(try_aes_decrypt(try_to_binary({c}, 'base64'), {KEY}, 'GCM') as string) END"
    )


def encrypt_member(c: str, kind: T.StructType, member: str) -> str:
    """A struct with one text member encrypted."""
    members = []
    for name in kind.fieldNames():
        value = f"{c}.{col(name)}"
        if name == member:
            text = value if isinstance(kind[name].dataType, T.StringType) else f"cast({value} as string)"
            value = encrypt_text(text)
        members.append(f"{lit(name)}, {value}")
    return f"if({c} IS NULL, NULL, named_struct({', '.join(members)}))"


def encrypt_members(c: str, kind: T.ArrayType, member: str) -> str:
    """An array of structs with the member of every element encrypted."""
    return f"transform({c}, element -> {encrypt_member('element', kind.elementType, member)})"


def variant_text(v: str) -> str:
    """Text of a JSON value: scalars as they are, lists and objects as JSON, null as null."""
    return f"try_variant_get({v}, '$', 'string')"


def is_json_container(v: str) -> str:
    return f"rlike(schema_of_variant({v}), '^(OBJECT|ARRAY)<')"


def _sealed_object(v: str, member: str) -> str:
    text = variant_text("v")
    sealed = f"parse_json(concat('\"', {_seal(text)}, '\"'))"
    hit = f"k = {lit(member)} AND coalesce({text} <> '', false) AND NOT {is_json_container('v')}"
    return (
        f"transform_values(try_variant_get({v}, '$', 'map<string,variant>'), "
        f"(k, v) -> CASE WHEN {hit} THEN {sealed} ELSE v END)"
    )


def _has_member(v: str, member: str) -> str:
    return f"coalesce(map_contains_key(try_variant_get({v}, '$', 'map<string,variant>'), {lit(member)}), false)"


def encrypt_variant(c: str, member: str, whole: bool = False) -> str:
    """A JSON value as text: a scalar is encrypted whole, an object in its
    ``member`` only, a list in the ``member`` of each object element. With ``whole``
    objects without it, and lists of anything else, are encrypted whole too."""
    if whole:
        each = f"startswith(schema_of_variant(e), 'OBJECT<') AND {_has_member('e', member)}"
        listed = f"coalesce(forall(try_variant_get({c}, '$', 'array<variant>'), e -> {each}), false)"
        plain = f"CASE WHEN startswith(schema_of_variant({c}), 'OBJECT<') THEN {_has_member(c, member)} ELSE {listed} END"
        part = f"{is_json_container(c)} AND {plain}"
        return f"CASE WHEN {part} THEN {encrypt_variant(c, member)} ELSE {encrypt_text(variant_text(c))} END"
    kind = f"schema_of_variant({c})"
    items = (
        f"transform(try_variant_get({c}, '$', 'array<variant>'), element -> "
        f"CASE WHEN startswith(schema_of_variant(element), 'OBJECT<') "
        f"THEN to_variant_object({_sealed_object('element', member)}) ELSE element END)"
    )
    return (
        f"CASE WHEN startswith({kind}, 'OBJECT<') THEN to_json({_sealed_object(c, member)}) "
        f"WHEN startswith({kind}, 'ARRAY<') THEN to_json({items}) "
        f"ELSE {encrypt_text(variant_text(c))} END"
    )


def encrypt_json_text(c: str, member: str) -> str:
    """Text that should be JSON with one secret member; text that is not is encrypted whole."""
    v = f"try_parse_json({c})"
    return f"CASE WHEN {is_json_container(v)} THEN {encrypt_variant(v, member)} ELSE {encrypt_text(c)} END"
