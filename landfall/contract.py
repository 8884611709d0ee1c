"""The JSON descriptor of one feed, read once on the driver."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

# Field names that are lists or wrapped objects in delimited
# files when the descriptor does not say so itself.
LIST_FIELDS = ("skills",)
OBJECT_FIELDS = ("address", "emergency_contact")

# Fixed value: encrypted fields that keep their own name in the warehouse.
UNRENAMED_ENCRYPTED_FIELDS = ("emergency_contact",)

FORMATS = ("CSV", "FIXEDWIDTH", "JSON", "XML")


class ContractError(ValueError):
    """The descriptor cannot be used; nothing is read."""


@dataclass(frozen=True)
class FieldRule:
    """What the descriptor says about one field.

    ``encrypt`` is None, "value" (by the shape of the value: text is encrypted
    whole, an object or a list of objects has its ``phone`` encrypted) or
    "phone" (the text is a JSON object whose ``phone`` is encrypted).
    ``shape`` is "text", "list", "object" or a DDL type for nested XML.
    """

    name: str
    required: bool = False
    encrypt: str | None = None
    sensitive: bool = False
    min_length: int | None = None
    max_length: int | None = None
    shape: str = "text"
    type: str | None = None
    pattern: str | None = None
    width: int | None = None
    not_null: bool = False
    allowed: tuple[str, ...] = ()
    target_name: str | None = None

    @property
    def warehouse_name(self) -> str:
        if self.target_name:
            return self.target_name
        if self.encrypt and self.name not in UNRENAMED_ENCRYPTED_FIELDS:
            return f"{self.name}_encrypted"
        return self.name


@dataclass(frozen=True)
class FixedColumn:
    name: str
    start: int
    length: int


@dataclass(frozen=True)
class Policy:
    """Where the strict reading and the lenient reading of a feed differ."""

    reject_missing: bool = True
    reject_overflow: bool = True
    trim_fixed_width: bool = True
    empty_nested_is_blank: bool = True
    check_lengths: bool = True

    @classmethod
    def lenient(cls) -> "Policy":
        return cls(False, False, False, False, False)


@dataclass(frozen=True)
class Contract:
    fields: tuple[FieldRule, ...]
    format: str = "CSV"
    delimiter: str = ","
    has_header: bool = True
    quote: str | None = None
    columns: tuple[FixedColumn, ...] = ()
    is_json_array: bool = False
    row_tag: str = "row"
    record_end: str | None = None
    target_table: str | None = None
    file_name: str | None = None
    policy: Policy = field(default_factory=Policy)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[FieldRule]:
        return [f for f in self.fields if f.required]

    @property
    def encrypted(self) -> list[FieldRule]:
        return [f for f in self.fields if f.encrypt]

    @property
    def holds_secrets(self) -> bool:
        return any(f.encrypt or f.sensitive for f in self.fields)

    def with_policy(self, policy: Policy) -> "Contract":
        return replace(self, policy=policy)

    def as_format(self, fmt: str) -> "Contract":
        return replace(self, format=check_format(fmt))


def check_format(fmt: str) -> str:
    name = fmt.upper()
    if name not in FORMATS:
        raise ContractError(f"Unsupported file format: {fmt}")
    return name


def _field_rule(name: str, rule: dict) -> FieldRule:
    if rule.get("encrypt_nested_phone"):
        encrypt = "phone"
    else:
        encrypt = "value" if rule.get("encrypt") else None
    if "shape" in rule:
        shape = rule["shape"]
    elif name in LIST_FIELDS:
        shape = "list"
    elif name in OBJECT_FIELDS:
        shape = "object"
    else:
        shape = "text"
    target = rule.get("target_name")
    if encrypt == "phone" and target is None:
        target = name
    return FieldRule(
        name=name,
        required=bool(rule.get("required", False)),
        encrypt=encrypt,
        sensitive=bool(rule.get("sensitive", False)),
        min_length=rule.get("min_length"),
        max_length=rule.get("max_length"),
        shape=shape,
        type=_type_name(name, rule.get("type")),
        pattern=rule.get("pattern"),
        width=rule.get("width"),
        not_null=bool(rule.get("not_null", False)),
        allowed=tuple(rule.get("allowed", ())),
        target_name=target,
    )


def _type_name(field: str, name: str | None) -> str | None:
    """A type as it may stand in SQL: a name, element types in angle brackets, numbers in round ones."""
    if name is not None and not re.fullmatch(r"[A-Za-z_][\w<>:, ]*(\(\s*\d+\s*(,\s*\d+\s*)?\))?", name):
        raise ContractError(f"field {field}: {name!r} is not a type")
    return name


def parse_contract(text: str, policy: Policy | None = None) -> Contract:
    try:
        doc = json.loads(text.removeprefix("﻿"))
    except ValueError as e:
        raise ContractError(f"descriptor is not JSON: {e}") from e
    rules = doc.get("fields") if isinstance(doc, dict) else None
    if not isinstance(rules, dict) or not rules:
        raise ContractError("descriptor has no fields")
    columns = tuple(
        FixedColumn(c.get("name", f"col{i}"), int(c["start"]), int(c["length"]))
        for i, c in enumerate(doc.get("columns", ()), start=1)
    )
    fmt = check_format(doc.get("format", "CSV"))
    if fmt == "FIXEDWIDTH" and not columns:
        raise ContractError("fixed-width descriptor has no columns")
    quote = doc.get("quote")
    if quote is not None and (fmt != "CSV" or len(quote) != 1 or quote in doc.get("delimiter", ",")):
        raise ContractError("quote must be one character of a delimited feed, and no delimiter")
    return Contract(
        fields=tuple(_field_rule(n, r) for n, r in rules.items()),
        format=fmt,
        delimiter=doc.get("delimiter", ","),
        has_header=bool(doc.get("csv_header", True)),
        quote=quote,
        columns=columns,
        is_json_array=bool(doc.get("is_json_array", False)),
        row_tag=doc.get("row_tag", "row"),
        record_end=doc.get("record_end"),
        target_table=doc.get("target_table"),
        file_name=doc.get("file_name"),
        policy=policy or Policy(),
    )


def load_contract(spark: SparkSession, path: str, policy: Policy | None = None) -> Contract:
    """Read a descriptor from any file system Spark can reach."""
    rows = spark.read.text(path, wholetext=True).head(1)
    if not rows:
        raise ContractError(f"descriptor is empty: {path}")
    return parse_contract(rows[0].value, policy)
