"""Queries over the bundled tables, one per operator, each with its SQL twin.

Every query renders whole tables (or takes their texts as they are), sends them
through the operator and returns rows the twin computes from the tables alone.
Faults are put into the rendered rows by their own attributes.
"""

from __future__ import annotations

from landfall.plans.catalog import files, parsing, protection, rules, runs
from landfall.plans.catalog.base import Query

CATALOG: dict[str, Query] = {
    **parsing.CATALOG, **rules.CATALOG, **protection.CATALOG, **runs.CATALOG, **files.CATALOG,
}
