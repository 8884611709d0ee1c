"""Control files: ``record_count=N`` per delivered run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.functions.sql import col
from landfall.functions.text import strip
from landfall.sources.scan import scan_text


class ControlFileError(ValueError):
    """The control file does not state a record count."""


def control_counts(lines: DataFrame, by: str, order: str) -> DataFrame:
    """One row per control file of ``value`` lines: its count, or why there is none.

    Comments, blanks and lines without '=' say nothing; the last entry wins.
    ``order`` is an expression that follows the lines of a file.
    """
    pair = "split(value, '=', 2)"
    is_count = (
        f"NOT startswith({strip('value')}, '#') AND size({pair}) = 2 "
        f"AND {strip(f'get({pair}, 0)')} = 'record_count'"
    )
    return (
        lines.selectExpr(
            col(by),
            f"CASE WHEN {is_count} THEN {strip(f'get({pair}, 1)')} END AS _stated",
            f"CASE WHEN {is_count} THEN {order} END AS _rank",
        )
        .groupBy(by)
        .agg(F.max_by("_stated", "_rank").alias("stated"))
        .selectExpr(
            col(by),
            "try_cast(stated as bigint) AS expected_count",
            """CASE WHEN coalesce(stated, '') = '' THEN 'missing \\'record_count\\' attribute'
                WHEN try_cast(stated as bigint) IS NULL
                    THEN concat('invalid \\'record_count\\' value \\'', stated, '\\'') END AS problem""",
        )
    )


def read_control_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Counts of many control files; each is far smaller than one file split, so line order is id order."""
    lines = scan_text(spark, paths).selectExpr(
        "value", "_source_file AS control_file", "monotonically_increasing_id() AS _line"
    )
    return control_counts(lines, "control_file", "_line")


def expected_count(spark: SparkSession, path: str | None) -> int | None:
    """The count one run expects. No path means no expectation; anything else unreadable is fatal."""
    if not path:
        return None
    rows = read_control_files(spark, path).take(2)
    if not rows:
        raise ControlFileError(f"control file {path}: missing 'record_count' attribute")
    if len(rows) > 1:
        raise ControlFileError(f"{path} holds more than one control file")
    if rows[0].problem:
        raise ControlFileError(f"control file {path}: {rows[0].problem}")
    return rows[0].expected_count
