"""Loaded rows against expected rows, for any number of runs at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from landfall.functions.sql import col

PASSED, FAILED, RUNNING = "PASSED", "FAILED", "RUNNING"


def load_counts(df: DataFrame, by: str = "execution_id") -> DataFrame:
    """Rows per run; counted in the scan tasks first, so one huge run is no hot spot."""
    return df.groupBy(by).agg(F.count("*").alias("actual_count"))


def reconcile(expected: DataFrame, actual: DataFrame, by: str = "execution_id") -> DataFrame:
    """Both sides hold one row per run. A run that loaded nothing has count 0; no control file passes."""
    # Fixed value: the text of a mismatch is part of the run log.
    return (
        expected.join(actual, by, "full")
        .selectExpr(col(by), "expected_count", "coalesce(actual_count, 0) AS actual_count")
        .selectExpr(
            "*",
            "actual_count - expected_count AS difference",
            f"if(expected_count <> actual_count, '{FAILED}', '{PASSED}') AS status",
            """CASE WHEN expected_count <> actual_count THEN concat('Record count mismatch! Expected: ', expected_count,
                ', Actual: ', actual_count, ', Difference: ', actual_count - expected_count) END AS failure_reason""",
        )
    )
