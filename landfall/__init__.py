"""Landfall: files in, governed tables out, on Spark.

Parsers, quality rules, column protection, run reconciliation and size-bounded
splitting, each one a plain DataFrame -> DataFrame function.
"""

from landfall.contract import Contract, FieldRule, Policy, load_contract, parse_contract

__all__ = ["Contract", "FieldRule", "Policy", "load_contract", "parse_contract"]
