"""One run: files to a landing table of good and bad rows, then the count check."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall.contract import Contract
from landfall.functions.crypto import encrypt_text, key_column, with_key
from landfall.functions.sql import col, ddl, lit
from landfall.operators import audit
from landfall.operators.enrich import LINEAGE, cleanse_nulls, stamp, warehouse_names, warehouse_texts
from landfall.operators.protect import encrypt_columns
from landfall.operators.quality import kinds_of, text_of, validate
from landfall.operators.reconcile import reconcile
from landfall.operators.routing import outcome
from landfall.operators.sinks import (
    JdbcTable, append_jdbc, attempt_dir, commit_attempt, committed_attempts, landing_session, loaded_in_jdbc, new_attempt, run_dir,
    with_message, write_error_text, write_landing,
)
from landfall.operators.shared_files import claimed
from landfall.operators.splitting import TARGET_KB
from landfall.plans.prepare import prepare
from landfall.plans.workspace import shared_dir
from landfall.sources.control import expected_count
from landfall.sources.feed import read_feed

ERROR_COLUMNS = ("error_type", "stage", "field", "reason", "data", "raw_record")


def _row_text(df: DataFrame, contract: Contract) -> str:
    """The row as JSON for the error report, secret fields masked."""
    kinds = kinds_of(df)
    secret = {f.name for f in contract.fields if f.encrypt or f.sensitive}
    members = ", ".join(
        f"{lit(n)}, {lit('***') if n in secret else text_of(col(n), kinds[n])}" for n in contract.names
    )
    return f"to_json(named_struct({members}))"


def landing_rows(
    parsed: DataFrame,
    contract: Contract,
    execution_id: str | Column,
    ingestion_ts: datetime | Column,
    key: Column | None = None,
) -> DataFrame:
    """Parsed rows to landing rows in one pass over the data, without a shuffle.

    A good row has its warehouse columns and no error columns, a bad row the
    other way round. When the contract holds secrets, the raw text of a bad row
    is kept encrypted (without a key it is not kept) and its readable text is masked.
    """
    checked = validate(cleanse_nulls(parsed, contract.names), contract)
    report = f"CASE WHEN _error.type <> 'PARSE_ERROR' THEN {_row_text(checked, contract)}"
    report += " END" if contract.holds_secrets else " WHEN _error IS NOT NULL THEN _raw END"
    named = encrypt_columns(checked.withColumn("_data", F.expr(report)), contract, key)
    made = F.col("_source_ts") if "_source_ts" in parsed.columns else ingestion_ts
    stamped = stamp(named, execution_id, ingestion_ts, made)
    texts = warehouse_texts(stamped, contract)
    origin = "_source_file" if "_source_file" in parsed.columns else "cast(NULL as string)"
    hide_raw = contract.holds_secrets and key is not None

    def shape(df: DataFrame) -> DataFrame:
        raw = encrypt_text("_raw") if hide_raw else "cast(NULL as string)" if contract.holds_secrets else "_raw"
        return df.selectExpr(
            *[f"CASE WHEN _error IS NULL THEN {e} END AS {col(n)}" for n, e in texts.items()],
            *LINEAGE,
            f"{origin} AS source_file",
            "_error.type AS error_type",
            "_error.stage AS stage",
            "_error.field AS field",
            "_error.reason AS reason",
            "_data AS data",
            f"CASE WHEN _error IS NOT NULL THEN {raw} END AS raw_record",
            f"{outcome('_error')} AS outcome",
        )

    return with_key(stamped, key, shape) if hide_raw else shape(stamped)


def landing_schema(contract: Contract) -> str:
    """Stated, not inferred: no file is opened to plan a read, and ids stay text."""
    texts = dict.fromkeys(warehouse_names(contract), "string")
    times = {"ingestion_timestamp": "timestamp", "source_creation_time": "timestamp"}
    rest = dict.fromkeys(("source_file", *ERROR_COLUMNS, "execution_id", "outcome"), "string")
    return ddl(texts | times | rest)


def _read(spark: SparkSession, location: str, contract: Contract, paths: list[str]) -> DataFrame:
    schema = landing_schema(contract)
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", location).parquet(*paths)
    return rows.drop("attempt")


def read_attempt(spark: SparkSession, location: str, contract: Contract, execution_id: str, attempt: str) -> DataFrame:
    """One attempt, committed or not."""
    return _read(spark, location, contract, [attempt_dir(location, execution_id, attempt)])


def read_landing(
    spark: SparkSession, location: str, contract: Contract, execution_id: str | None = None
) -> DataFrame:
    """All runs, or one of them, each by the attempt that was committed last."""
    current = committed_attempts(spark, location)
    runs = current if execution_id is None else current.keys() & {execution_id}
    return _read(spark, location, contract, [attempt_dir(location, run, current[run]) for run in sorted(runs)])


def _loaded(rows: DataFrame, contract: Contract) -> DataFrame:
    return rows.filter(F.col("outcome") == "valid").select(*[col(n) for n in warehouse_names(contract)], *LINEAGE)


def _rejected(rows: DataFrame) -> DataFrame:
    bad = rows.filter(F.col("outcome") == "error")
    return with_message(bad.select("execution_id", "source_file", "ingestion_timestamp", *ERROR_COLUMNS))


def loaded_rows(
    spark: SparkSession, location: str, contract: Contract, execution_id: str | None = None
) -> DataFrame:
    """The warehouse table: good rows; the outcome filter prunes directories."""
    return _loaded(read_landing(spark, location, contract, execution_id), contract)


def rejected_rows(
    spark: SparkSession, location: str, contract: Contract, execution_id: str | None = None
) -> DataFrame:
    return _rejected(read_landing(spark, location, contract, execution_id))


@dataclass(frozen=True)
class IntakeJob:
    paths: Sequence[str]
    contract: Contract
    location: str
    audit_dir: str
    control_path: str | Callable[[], str | None] | None = None
    base64_key: str | None = field(default=None, repr=False)
    execution_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    started: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    database: JdbcTable | None = None
    split_above_kb: int | None = None
    part_kb: int = TARGET_KB
    report_dir: str | None = None
    claim_hours: float = 24.0


@dataclass(frozen=True)
class IntakeResult:
    execution_id: str
    status: str
    expected_count: int | None
    actual_count: int
    error_count: int
    failure_reason: str | None


def _event(job: IntakeJob, seq: int, kind: str, **values) -> dict:
    return {
        "execution_id": job.execution_id,
        "attempt": job.started,
        "seq": seq,
        "kind": kind,
        "event_time": datetime.now(timezone.utc),
        **values,
    }


def _start_event(job: IntakeJob) -> dict:
    first = job.paths[0] if job.paths else ""
    return _event(
        job, 0, audit.STARTED, status="RUNNING", file_path=first, file_name=first.rsplit("/", 1)[-1],
        file_type=job.contract.format, target_table=job.contract.target_table,
    )


def _refuse_second_load(spark: SparkSession, job: IntakeJob) -> None:
    """Appending cannot replace what an earlier attempt loaded, so a run that is there already is refused."""
    if loaded_in_jdbc(spark, job.database, job.execution_id):
        raise ValueError(f"{job.database.table} already holds rows of run {job.execution_id}; remove them first")


def _load_database(spark: SparkSession, job: IntakeJob, landed: DataFrame) -> int:
    """Good rows as they were landed, whose ciphertext no longer changes, to the database."""
    append_jdbc(_loaded(landed, job.contract), job.database)
    return loaded_in_jdbc(spark, job.database, job.execution_id)


def _source(spark: SparkSession, job: IntakeJob) -> tuple[list[str], Contract]:
    """The files of the run, or their parts if the job splits what is above a threshold."""
    paths = list(job.paths)
    if job.split_above_kb is None:
        return paths, job.contract
    return prepare(spark, paths, job.contract, shared_dir(spark, "parts"), job.split_above_kb, job.part_kb)


def run_intake(spark: SparkSession, job: IntakeJob) -> IntakeResult:
    """Land all files of a run, load them into a database and write the text report of
    bad rows if these are named, check the counts and log the run.

    The rows are written to a directory of this attempt and become the run's by one commit file, so a
    later attempt that fails changes nothing, and readers see one whole attempt at any time. While an
    attempt is at work, another one of the same run is refused (RunClaimed). A count mismatch is recorded
    as FAILED and does not raise; any other problem is recorded as FAILED and raised again.
    """
    if not job.paths or not job.execution_id:
        raise ValueError("a run needs at least one path and an execution id")
    spark = landing_session(spark)
    with claimed(spark, job.location, job.execution_id, job.claim_hours):
        return _run(spark, job)


def _run(spark: SparkSession, job: IntakeJob) -> IntakeResult:
    attempt = new_attempt(job.started)
    audit.append_events(spark, [_start_event(job)], job.audit_dir)
    try:
        key = key_column(spark, job.base64_key) if job.contract.encrypted or job.base64_key else None
        if job.database:  # before anything is written
            _refuse_second_load(spark, job)
        expected = expected_count(spark, job.control_path() if callable(job.control_path) else job.control_path)
        parsed = read_feed(spark, *_source(spark, job))
        rows = landing_rows(parsed, job.contract, job.execution_id, job.started, key)
        counts = write_landing(rows, job.location, job.execution_id, attempt)
        landed = read_attempt(spark, job.location, job.contract, job.execution_id, attempt)
        actual = _load_database(spark, job, landed) if job.database else counts["valid"]
        if job.report_dir:
            write_error_text(_rejected(landed), run_dir(job.report_dir, job.execution_id))
        want = spark.createDataFrame([(job.execution_id, expected)], "execution_id string, expected_count bigint")
        got = spark.createDataFrame([(job.execution_id, actual)], "execution_id string, actual_count bigint")
        result = reconcile(want, got).first()
        commit_attempt(spark, job.location, job.execution_id, attempt, counts)
        audit.append_events(
            spark,
            [
                _event(job, 1, audit.COMMITTED),
                *([_event(job, 2, audit.COUNTED, expected_count=expected)] if expected is not None else []),
                _event(job, 3, audit.COUNTED, actual_count=actual),
                _event(job, 4, audit.FINISHED, status=result.status, failure_reason=result.failure_reason),
            ],
            job.audit_dir,
        )
    except Exception as e:
        reason = (str(e) or "Unknown error")[: audit.REASON_CHARS]
        audit.append_events(spark, [_event(job, 5, audit.ABORTED, failure_reason=reason)], job.audit_dir)
        raise
    return IntakeResult(job.execution_id, result.status, expected, actual, counts["error"], result.failure_reason)
