"""Before a run: split what is too large for the tasks that would parse it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from landfall.contract import Contract
from landfall.operators.splitting import TARGET_KB, THRESHOLD_KB, split_files, split_plan


def exceeds_threshold(spark: SparkSession, path: str | Sequence[str], threshold_kb: int = THRESHOLD_KB) -> bool:
    """Whether any file under the path is above the threshold; a path that is not there is not."""
    try:
        return bool(split_plan(spark, path, threshold_kb).filter("split").take(1))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def prepare(
    spark: SparkSession,
    path: str | Sequence[str],
    contract: Contract,
    out_dir: str,
    threshold_kb: int = THRESHOLD_KB,
    target_kb: int = TARGET_KB,
) -> tuple[list[str], Contract]:
    """What to land: the path as it is, or its parts under ``out_dir``.

    Line formats and XML do not need this, as their scans are cut into tasks
    anyway; it spares a JSON array from being parsed whole a second time. Parts
    of JSON are JSON lines, which the returned contract says. The rows are the same
    either way, but for their source file, which is the part.
    """
    if not exceeds_threshold(spark, path, threshold_kb):
        return [path] if isinstance(path, str) else list(path), contract
    split_files(spark, path, contract, out_dir, target_kb)
    return [out_dir], replace(contract, is_json_array=False, record_end=None)
