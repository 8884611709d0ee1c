"""Fixed-width text: 1-based start and length, clipped at the end of the line."""

from __future__ import annotations

from pyspark.sql import DataFrame

from landfall.contract import Contract
from landfall.functions.errors import NO_ERROR
from landfall.functions.sql import array, col, lit
from landfall.functions.text import strip


def parse_fixed_width(lines: DataFrame, contract: Contract) -> DataFrame:
    """Only empty lines are dropped; a short line gives '' for the rest."""
    carried = [col(c) for c in lines.columns if c != "value"]
    cells = {c.name: f"substring(value, {c.start}, {c.length})" for c in contract.columns}
    if contract.policy.trim_fixed_width:
        cells = {n: strip(c) for n, c in cells.items()}
    missing = [lit(f.name) for f in contract.fields if f.name not in cells]
    return lines.filter("value <> ''").selectExpr(
        *carried,
        "value AS _raw",
        *[f"{cells.get(f.name, 'cast(NULL as string)')} AS {col(f.name)}" for f in contract.fields],
        f"{array(missing) if missing else 'cast(NULL as array<string>)'} AS _missing",
        f"{NO_ERROR} AS _error",
    )
