"""Quoting for expression text."""

from __future__ import annotations


def col(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def lit(value: str | int | bool | None) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def array(items: list[str]) -> str:
    """An array of texts; typed also when empty."""
    return f"cast(array({', '.join(items)}) as array<string>)"


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{col(n)} {t}" for n, t in columns.items())


def options(values: dict[str, str]) -> str:
    return "map(" + ", ".join(f"{lit(k)}, {lit(v)}" for k, v in values.items()) + ")"


def once(c: str) -> str:
    """The same value, evaluated once per row wherever it is used.

    Filters on a parsed or checked column would otherwise be pushed below the
    projection that makes it, and the parse be evaluated a second time there.
    Spark does not move what depends on the partition.
    """
    return f"if(spark_partition_id() >= 0, {c}, NULL)"
