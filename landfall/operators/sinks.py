"""Where rows end up: the landing table, Parquet tables, text reports, JDBC."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from landfall.functions.errors import humanize
from landfall.operators.routing import error_report
from landfall.operators.shared_files import create_file, names_in, quoted, read_file


def landing_session(spark: SparkSession) -> SparkSession:
    """A session of a run's own, with the settings of ``spark``, for write_landing()."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.get(name, None) != value:
            own.conf.set(name, value)
    keep_writers_open(own)
    return own


def keep_writers_open(session: SparkSession) -> None:
    """Tasks of this session write good and bad rows side by side instead of sorting them."""
    session.conf.set("spark.sql.maxConcurrentOutputFileWriters", "4")


def run_dir(location: str, execution_id: str) -> str:
    return f"{location.rstrip('/')}/execution_id={quoted(execution_id)}"


def attempt_dir(location: str, execution_id: str, attempt: str) -> str:
    return f"{run_dir(location, execution_id)}/attempt={attempt}"


def new_attempt(started: datetime) -> str:
    """A name that sorts by the time the attempt started."""
    return f"{started.astimezone(timezone.utc):%Y%m%dT%H%M%S%fZ}-{uuid.uuid4().hex[:8]}"


def write_landing(df: DataFrame, location: str, execution_id: str, attempt: str) -> dict[str, int]:
    """Good and bad rows of one attempt in one pass, in a directory of its own; how many of each, as the write saw them.

    Readers do not see the attempt before commit_attempt().
    """
    seen = Observation()
    counts = [F.count_if(F.col("outcome") == kind).alias(kind) for kind in ("valid", "error")]
    rows = df.drop("execution_id").observe(seen, *counts)
    rows.write.mode("errorifexists").partitionBy("outcome").parquet(attempt_dir(location, execution_id, attempt))
    return {kind: int(n) for kind, n in seen.get.items()}


def commit_attempt(spark: SparkSession, location: str, execution_id: str, attempt: str, counts: dict[str, int]) -> None:
    """One file makes the attempt the run's: from then on readers see it, and no earlier one."""
    create_file(spark, f"{location.rstrip('/')}/_commits/run={quoted(execution_id)}@{attempt}", json.dumps(counts))


def committed_attempts(spark: SparkSession, location: str) -> dict[str, str]:
    """The attempt that counts of each run."""
    found = {}
    for name in names_in(spark, f"{location.rstrip('/')}/_commits"):
        if name.startswith("run="):
            run, attempt = name.removeprefix("run=").rsplit("@", 1)
            found[unquote(run)] = max(attempt, found.get(unquote(run), ""))
    return found


def committed_counts(spark: SparkSession, location: str, execution_id: str) -> dict[str, int] | None:
    """The counts that the run was committed with; None for a run that is not."""
    attempt = committed_attempts(spark, location).get(execution_id)
    name = f"{location.rstrip('/')}/_commits/run={quoted(execution_id)}@{attempt}"
    return json.loads(read_file(spark, name)) if attempt else None


def superseded_attempts(spark: SparkSession, location: str) -> DataFrame:
    """(execution_id, attempt, path) of what no reader follows: earlier attempts, and attempts that were never committed.

    What is not committed may still be on its way if the run is claimed; those are left out.
    """
    current, rows = committed_attempts(spark, location), []
    for folder in names_in(spark, location):
        if not folder.startswith("execution_id="):
            continue
        run = unquote(folder.removeprefix("execution_id="))
        on_its_way = [n for n in names_in(spark, f"{location.rstrip('/')}/_claims/{quoted(run)}") if not n.startswith(".")]
        for name in names_in(spark, run_dir(location, run)):
            attempt = name.removeprefix("attempt=")
            if name.startswith("attempt=") and attempt != current.get(run) and (attempt < current.get(run, "") or not on_its_way):
                rows.append((run, attempt, attempt_dir(location, run, attempt)))
    return spark.createDataFrame(rows, "execution_id string, attempt string, path string")


def write_table(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Replace only the partitions that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_error_text(errors: DataFrame, path: str) -> None:
    """The readable report, in as many files as there are partitions."""
    at = "date_format(ingestion_timestamp, \"yyyy-MM-dd'T'HH:mm:ss.SSSXXX\")"
    block = error_report(at, "error_type", "stage", "field", "message", "data")
    errors.selectExpr(f"concat({block}, '\\n') AS value").write.mode("overwrite").text(path)


def with_message(df: DataFrame) -> DataFrame:
    return df.withColumn("message", F.expr(humanize("error_type", "field", "reason")))


@dataclass(frozen=True)
class JdbcTable:
    """A database table and how to reach it."""

    url: str
    table: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    batch: int = 5000
    connections: int = 32

    def options(self) -> dict[str, str]:
        return {
            "url": self.url, "dbtable": self.table, "user": self.user, "password": self.password,
            "driver": self.driver, "batchsize": str(self.batch), "numPartitions": str(self.connections),
        }


def append_jdbc(df: DataFrame, target: JdbcTable) -> None:
    """Append over a bounded number of connections.

    Each partition is one transaction, so a task that is lost between its commit
    and its report is loaded twice; the count check of the run shows it.
    """
    df.write.format("jdbc").options(**target.options()).mode("append").save()


def count_query(target: JdbcTable, execution_id: str) -> str:
    run = execution_id.replace("'", "''")
    return f"SELECT count(*) AS n FROM {target.table} WHERE execution_id = '{run}'"


def loaded_in_jdbc(spark: SparkSession, target: JdbcTable, execution_id: str) -> int:
    """How many rows the table holds of one run; the database counts them."""
    reach = {k: v for k, v in target.options().items() if k not in ("dbtable", "numPartitions", "batchsize")}
    return int(spark.read.format("jdbc").options(**reach).option("query", count_query(target, execution_id)).load().first()[0])
