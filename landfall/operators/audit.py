"""Run audit: an append-only log of events, and the state of each run folded from it.

A run may be tried again under its id. Each try is an ``attempt`` (the time it
started) and writes its events in order of ``seq``: started, counted, finished
or aborted. Two plain aggregations give the current state, so no run is ever
brought into one task and no row is updated in place. Compaction merges the many small
files of the log into a few, by run; what is appended meanwhile stays beside them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.operators.reconcile import FAILED, PASSED, RUNNING
from landfall.operators.shared_files import create_file, delete, names_in, read_file

REASON_CHARS = 1000

# Kinds of event. ABORTED is a failure raised by the job itself: it does not
# take back a PASSED of the same attempt. COMMITTED says that readers follow the attempt.
STARTED, COMMITTED, COUNTED, FINISHED, ABORTED = "STARTED", "COMMITTED", "COUNTED", "FINISHED", "ABORTED"
#: Files that compaction spreads the runs over.
BUCKETS = 16

EVENT_SCHEMA = """execution_id string, attempt timestamp, seq bigint, kind string, event_time timestamp,
    status string, expected_count bigint, actual_count bigint, failure_reason string,
    file_path string, file_name string, file_type string, target_table string"""

ORIGIN = ("file_path", "file_name", "file_type", "target_table")
COUNTS = ("expected_count", "actual_count")


def append_events(spark: SparkSession, events: list[dict], audit_dir: str) -> None:
    """Append a handful of events of one run as one file."""
    spark.createDataFrame(events, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(audit_dir)


def _generations(spark: SparkSession, audit_dir: str) -> list[tuple[str, list[str]]]:
    """Compacted folders, oldest first, and the names of the log's files that each one holds."""
    folder = f"{audit_dir.rstrip('/')}/_compacted"
    names = [n for n in names_in(spark, folder) if n.endswith(".json")]
    return [(f"{folder}/{n.removesuffix('.json')}", json.loads(read_file(spark, f"{folder}/{n}"))) for n in names]


def _tail(spark: SparkSession, audit_dir: str, held: set[str]) -> list[str]:
    return [n for n in names_in(spark, audit_dir) if n.endswith(".parquet") and not n.startswith(".") and n not in held]


def read_events(spark: SparkSession, audit_dir: str, execution_id: str | None = None) -> DataFrame:
    """All events, or those of one run without reading the compacted ones of the others."""
    generations = _generations(spark, audit_dir)
    if not generations:
        rows = spark.read.schema(EVENT_SCHEMA).parquet(audit_dir)
    else:
        folder, held = generations[-1]
        rows = spark.read.schema(EVENT_SCHEMA).parquet(folder).drop("bucket")
        if execution_id is not None:
            bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(execution_id)), F.lit(BUCKETS))).first()[0]
            rows = spark.read.schema(f"{EVENT_SCHEMA}, bucket int").parquet(folder).filter(F.col("bucket") == int(bucket)).drop("bucket")
        tail = [f"{audit_dir.rstrip('/')}/{n}" for n in _tail(spark, audit_dir, set(held))]
        if tail:
            rows = rows.unionByName(spark.read.schema(EVENT_SCHEMA).parquet(*tail))
    return rows if execution_id is None else rows.filter(F.col("execution_id") == execution_id)


def compact_events(spark: SparkSession, audit_dir: str) -> int:
    """Merges the log into a file for each bucket of runs; returns how many files were merged.

    The new files count from the moment their list of merged files appears, so a compaction that
    fails, and events appended meanwhile, change nothing. Merged files go at the next compaction, when nobody who
    began before this one can still be reading them.
    """
    generations = _generations(spark, audit_dir)
    held = generations[-1][1] if generations else []
    tail = _tail(spark, audit_dir, set(held))
    if not tail:
        return 0
    base = audit_dir.rstrip("/")
    rows = spark.read.schema(EVENT_SCHEMA).parquet(*[f"{base}/{n}" for n in tail])
    if generations:
        rows = rows.unionByName(spark.read.schema(EVENT_SCHEMA).parquet(generations[-1][0]).drop("bucket"))
    name = f"{base}/_compacted/{len(generations):08d}-{uuid.uuid4().hex[:8]}"
    spread = rows.withColumn("bucket", F.pmod(F.xxhash64("execution_id"), F.lit(BUCKETS)).cast("int"))
    spread.repartition(BUCKETS, "bucket").sortWithinPartitions("bucket", "execution_id", "attempt", "seq").write.partitionBy("bucket").parquet(name)
    for path in held:  # merged the last time
        delete(spark, f"{base}/{path}")
    create_file(spark, f"{name}.json", json.dumps(tail))
    for old, _ in generations[:-1]:
        delete(spark, old)
    return len(tail)


def abort_reason(message: str) -> str:
    return f"substring(coalesce({message}, 'Unknown error'), 1, {REASON_CHARS})"


def _last(c: str, order: str) -> str:
    return f"max_by({c}, CASE WHEN {c} IS NOT NULL THEN {order} END) AS {c}"


def _first(c: str, order: str) -> str:
    return f"min_by({c}, CASE WHEN {c} IS NOT NULL THEN {order} END) AS {c}"


def _agg(df: DataFrame, by: list[str], aggregates: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.expr(a) for a in aggregates])


def attempt_states(events: DataFrame) -> DataFrame:
    """One row per run and attempt. After a PASSED, an abort of the same attempt is ignored."""
    return _agg(
        events,
        ["execution_id", "attempt"],
        [
            f"bool_or(coalesce(status = '{PASSED}', false)) AS _passed",
            f"bool_or(kind = '{ABORTED}' OR coalesce(status = '{FAILED}', false)) AS _failed",
            f"bool_or(kind = '{COMMITTED}') AS committed",
            *[_last(c, "seq") for c in (*COUNTS, "failure_reason")],
            *[_first(c, "seq") for c in ORIGIN],
            "min(event_time) AS first_time",
            "max(event_time) AS _last_time",
            f"max(CASE WHEN kind <> '{ABORTED}' THEN event_time END) AS _last_kept",
        ],
    ).selectExpr(
        "execution_id",
        "attempt",
        f"CASE WHEN _passed THEN '{PASSED}' WHEN _failed THEN '{FAILED}' ELSE '{RUNNING}' END AS status",
        "CASE WHEN NOT _passed THEN failure_reason END AS failure_reason",
        *COUNTS,
        *ORIGIN,
        "committed",
        "first_time",
        "if(_passed, _last_kept, _last_time) AS last_time",
    )


def _current(c: str) -> str:
    """The last known value of the committed attempts; of all attempts if none is committed."""
    of = lambda wanted: f"max_by({c}, CASE WHEN {c} IS NOT NULL AND {wanted} THEN attempt END)"
    return f"CASE WHEN bool_or(committed) THEN {of('committed')} ELSE {of('true')} END AS {c}"


def run_states(events: DataFrame) -> DataFrame:
    """The current row of each run: status of the last attempt, the last known counts and
    reason (a later attempt does not clear them), and where the run first came from. Once an attempt
    is committed, only committed attempts count."""
    return _agg(
        attempt_states(events),
        ["execution_id"],
        [
            *[_first(c, "attempt") for c in ORIGIN],
            *[_current(c) for c in (*COUNTS, "status", "failure_reason")],
            "min(attempt) AS execution_timestamp",
            "min(first_time) AS creation_timestamp",
            "max(last_time) AS updated_timestamp",
        ],
    )


def failure_report(states: DataFrame, execution_id: str | None = None) -> DataFrame:
    """The details of one run, or of all failed ones."""
    chosen = F.col("status") == FAILED if execution_id is None else F.col("execution_id") == execution_id
    return states.filter(chosen).selectExpr(
        "execution_id", *ORIGIN, *COUNTS, "actual_count - expected_count AS difference",
        "status", "failure_reason", "execution_timestamp", "creation_timestamp",
    )


def recent_runs(states: DataFrame, n: int = 5) -> DataFrame:
    return states.orderBy(F.desc("creation_timestamp"), F.desc("execution_id")).limit(n)
