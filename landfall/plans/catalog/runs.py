"""Lineage, warehouse columns, counts, reconciliation and the run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.contract import Contract, FieldRule
from landfall.functions.errors import NO_ERROR
from landfall.functions.text import parse_instant
from landfall.operators import audit
from landfall.operators.enrich import stamp, warehouse_projection
from landfall.operators.reconcile import load_counts, reconcile
from landfall.plans.catalog.base import Query, feed, rendered, table
from landfall.plans.workspace import shared_dir
from landfall.sources.control import control_counts
from landfall.sources.feed import read_feed


def lineage_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    at = F.expr("timestamp'2026-01-02T03:04:05Z'")
    return stamp(rows, "run-1", at, F.col("l_shipdate")).selectExpr(
        "l_orderkey", "l_linenumber", "execution_id", "unix_seconds(ingestion_timestamp) AS ingested",
        "date_format(source_creation_time, 'yyyy-MM-dd') AS made",
    )


LINEAGE_COLUMNS = """
SELECT l_orderkey, l_linenumber, 'run-1' AS execution_id, 1767323045 AS ingested,
       strftime(l_shipdate, '%Y-%m-%d') AS made
FROM lineitem"""


def lines_of_warehouse(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) AS id", "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS prio",
        "split(o_orderpriority, '-') AS words", "named_struct('raw', o_orderstatus) AS place",
        "cast(o_custkey as string) AS phone", "o_orderstatus AS emergency_contact", f"{NO_ERROR} AS _error",
    )
    contract = Contract((
        FieldRule("phone", encrypt="value"), FieldRule("id"), FieldRule("prio", target_name="priority"),
        FieldRule("words"), FieldRule("place"), FieldRule("emergency_contact", encrypt="value"),
    ))
    stamped = stamp(rows, F.expr("CASE WHEN prio IS NULL THEN NULL ELSE 'run-1' END"), F.lit(1), F.lit(2))
    return warehouse_projection(stamped, contract)


WAREHOUSE_PROJECTION = """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE o_orderpriority END AS priority,
       '["' || array_to_string(string_split(o_orderpriority, '-'), '","') || '"]' AS words,
       '{"raw":"' || o_orderstatus || '"}' AS place, CAST(o_custkey AS VARCHAR) AS phone_encrypted,
       o_orderstatus AS emergency_contact, 1 AS ingestion_timestamp,
       CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE 'run-1' END AS execution_id, 2 AS source_creation_time
FROM orders"""


def iso_timestamps(spark, sf_dir):
    text = (
        "CASE event_type WHEN 'error' THEN ' ' WHEN 'signup' THEN 'yesterday' "
        "WHEN 'view' THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") "
        "ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'+02:00'\") END"
    )
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{text} AS t").selectExpr(
        "event_id", f"unix_millis({parse_instant('t')}) AS millis"
    )


ISO_TIMESTAMPS = """
SELECT event_id, CASE event_type WHEN 'view' THEN epoch_us(ts) // 1000 WHEN 'error' THEN NULL WHEN 'signup' THEN NULL
       ELSE epoch_us(date_trunc('second', ts)) // 1000 - 7200000 END AS millis
FROM events"""


def multi_file_union(spark, sf_dir):
    """Two feeds of text files read as one run; each row knows its file, and so its feed."""
    paths = [shared_dir(spark, "csv") for _ in "cs"]
    for path, (name, c) in zip(paths, (("customer", "c"), ("supplier", "s")), strict=True):
        table(spark, sf_dir, name).selectExpr(f"{c}_name AS value").write.text(path)
    rows = read_feed(spark, paths, feed("name", has_header=False)).filter("_error IS NULL AND name <> ''")
    return rows.selectExpr("'run-1' AS execution_id", "element_at(split(_source_file, '/'), -2) AS folder").groupBy(
        "execution_id"
    ).agg(F.count("*").alias("n_rows"), F.countDistinct("folder").alias("n_files"))


MULTI_FILE_UNION = """
SELECT 'run-1' AS execution_id, (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) AS n_rows,
       2 AS n_files"""


def run_load_counts(spark, sf_dir):
    return load_counts(table(spark, sf_dir, "lineitem").selectExpr("cast(l_orderkey as string) AS execution_id"))


CONTROL_LINE = (
    "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'record_count=' || o_orderstatus "
    "WHEN o_orderstatus = 'F' THEN '  record_count = ' || o_custkey || ' ' "
    "WHEN o_orderpriority = '1-URGENT' THEN '# record_count=1' WHEN o_orderpriority = '2-HIGH' THEN '' "
    "WHEN o_orderpriority = '3-MEDIUM' THEN 'record_count' ELSE 'owner=' || o_custkey || '=x' END"
)


def control_files(spark, sf_dir):
    lines = rendered(table(spark, sf_dir, "orders"), CONTROL_LINE, "o_custkey", "o_orderkey")
    return control_counts(lines, "o_custkey", "o_orderkey")


CONTROL_FILES = """
WITH s AS (SELECT o_custkey, arg_max(CASE WHEN o_orderpriority = '5-LOW' THEN 'F' ELSE CAST(o_custkey AS VARCHAR) END,
                                     o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS stated
           FROM orders GROUP BY o_custkey)
SELECT o_custkey, CASE WHEN stated <> 'F' THEN CAST(stated AS BIGINT) END AS expected_count,
       CASE WHEN stated IS NULL THEN 'missing ''record_count'' attribute'
            WHEN stated = 'F' THEN 'invalid ''record_count'' value ''F''' END AS problem
FROM s"""


def reconcile_runs(spark, sf_dir):
    actual = load_counts(table(spark, sf_dir, "orders").selectExpr("o_custkey AS execution_id"))
    expected = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS execution_id",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE cast(c_nationkey as bigint) END AS expected_count",
    )
    return reconcile(expected, actual)


RECONCILE_RUNS = """
WITH a AS (SELECT o_custkey AS execution_id, count(*) AS n FROM orders GROUP BY 1),
e AS (SELECT c_custkey AS execution_id,
             CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS x FROM customer),
j AS (SELECT coalesce(e.execution_id, a.execution_id) AS execution_id, x, coalesce(n, 0) AS n
      FROM e FULL JOIN a ON e.execution_id = a.execution_id)
SELECT execution_id, x AS expected_count, n AS actual_count, n - x AS difference,
       CASE WHEN x <> n THEN 'FAILED' ELSE 'PASSED' END AS status,
       CASE WHEN x <> n THEN 'Record count mismatch! Expected: ' || x || ', Actual: ' || n || ', Difference: '
                             || (n - x) END AS failure_reason
FROM j"""


def _event_log(spark, sf_dir):
    """User activity read as a run log: an attempt per hour, its events in order of id."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) AS execution_id", "date_trunc('hour', ts) AS attempt", "event_id AS seq",
        "CASE event_type WHEN 'view' THEN 'STARTED' WHEN 'click' THEN 'COUNTED' WHEN 'error' THEN 'ABORTED' "
        "ELSE 'FINISHED' END AS kind",
        "ts AS event_time",
        "CASE event_type WHEN 'view' THEN 'RUNNING' WHEN 'purchase' THEN 'PASSED' WHEN 'signup' THEN 'FAILED' END AS status",
        "CASE WHEN event_type = 'click' AND value < 20 THEN event_id END AS expected_count",
        "CASE WHEN event_type = 'click' AND value >= 20 THEN event_id END AS actual_count",
        f"CASE event_type WHEN 'error' THEN {audit.abort_reason('props')} WHEN 'signup' THEN 'mismatch' END "
        "AS failure_reason",
        "CASE WHEN event_type = 'view' THEN concat('/in/', event_id) END AS file_path",
        "CASE WHEN event_type = 'view' THEN cast(event_id as string) END AS file_name",
        "CASE WHEN event_type = 'view' THEN 'CSV' END AS file_type",
        "CASE WHEN event_type = 'view' THEN 'stg' END AS target_table",
    )


def _texts(df):
    times = ("execution_timestamp", "creation_timestamp", "updated_timestamp")
    return df.selectExpr(*[
        f"date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {c}" if c in times else c for c in df.columns
    ])


def run_state_latest(spark, sf_dir):
    return _texts(audit.run_states(_event_log(spark, sf_dir)))


def failure_report(spark, sf_dir):
    return _texts(audit.failure_report(audit.run_states(_event_log(spark, sf_dir))))


def recent_runs(spark, sf_dir):
    return _texts(audit.recent_runs(audit.run_states(_event_log(spark, sf_dir)), 5))


STATES = """
WITH ev AS (
    SELECT CAST(user_id AS VARCHAR) AS execution_id, date_trunc('hour', ts) AS attempt, event_id, ts, event_type, value,
           CASE event_type WHEN 'error' THEN props WHEN 'signup' THEN 'mismatch' END AS reason
    FROM events),
att AS (
    SELECT execution_id, attempt, bool_or(event_type = 'purchase') AS passed,
           bool_or(event_type IN ('error', 'signup')) AS failed,
           arg_max(reason, event_id) FILTER (WHERE reason IS NOT NULL) AS reason,
           max(event_id) FILTER (WHERE event_type = 'click' AND value < 20) AS expected_count,
           max(event_id) FILTER (WHERE event_type = 'click' AND value >= 20) AS actual_count,
           min(event_id) FILTER (WHERE event_type = 'view') AS first_view, min(ts) AS t0, max(ts) AS t1,
           max(ts) FILTER (WHERE event_type <> 'error') AS t1_kept
    FROM ev GROUP BY 1, 2),
runs AS (
    SELECT execution_id,
           arg_min(first_view, attempt) FILTER (WHERE first_view IS NOT NULL) AS first_view,
           arg_max(expected_count, attempt) FILTER (WHERE expected_count IS NOT NULL) AS expected_count,
           arg_max(actual_count, attempt) FILTER (WHERE actual_count IS NOT NULL) AS actual_count,
           arg_max(CASE WHEN passed THEN 'PASSED' WHEN failed THEN 'FAILED' ELSE 'RUNNING' END, attempt) AS status,
           arg_max(reason, attempt) FILTER (WHERE NOT passed AND reason IS NOT NULL) AS failure_reason,
           min(attempt) AS a0, min(t0) AS t0, max(CASE WHEN passed THEN t1_kept ELSE t1 END) AS t1
    FROM att GROUP BY 1),
states AS (
    SELECT execution_id, '/in/' || first_view AS file_path, CAST(first_view AS VARCHAR) AS file_name,
           CASE WHEN first_view IS NOT NULL THEN 'CSV' END AS file_type,
           CASE WHEN first_view IS NOT NULL THEN 'stg' END AS target_table, expected_count, actual_count, status,
           failure_reason, strftime(a0, '%Y-%m-%d %H:%M:%S.%f') AS execution_timestamp,
           strftime(t0, '%Y-%m-%d %H:%M:%S.%f') AS creation_timestamp,
           strftime(t1, '%Y-%m-%d %H:%M:%S.%f') AS updated_timestamp
    FROM runs)
"""

FAILURE_REPORT = STATES + """
SELECT execution_id, file_path, file_name, file_type, target_table, expected_count, actual_count,
       actual_count - expected_count AS difference, status, failure_reason, execution_timestamp, creation_timestamp
FROM states WHERE status = 'FAILED'"""


def abort_reasons(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "CASE WHEN lang = 'de' THEN NULL ELSE text END AS message"
    )
    return rows.selectExpr("doc_id", f"{audit.abort_reason('message')} AS failure_reason")


CATALOG = {
    "lineage_columns": Query(lineage_columns, LINEAGE_COLUMNS),
    "warehouse_projection": Query(lines_of_warehouse, WAREHOUSE_PROJECTION),
    "iso_timestamps": Query(iso_timestamps, ISO_TIMESTAMPS),
    "multi_file_union": Query(multi_file_union, MULTI_FILE_UNION),
    "load_counts": Query(
        run_load_counts,
        "SELECT CAST(l_orderkey AS VARCHAR) AS execution_id, count(*) AS actual_count FROM lineitem GROUP BY 1",
    ),
    "control_files": Query(control_files, CONTROL_FILES),
    "reconcile_runs": Query(reconcile_runs, RECONCILE_RUNS),
    "run_state_latest": Query(run_state_latest, STATES + "SELECT * FROM states"),
    "failure_report": Query(failure_report, FAILURE_REPORT),
    "recent_runs": Query(
        recent_runs, STATES + "SELECT * FROM states ORDER BY creation_timestamp DESC, execution_id DESC LIMIT 5"
    ),
    "abort_reasons": Query(
        abort_reasons,
        "SELECT doc_id, CASE WHEN lang = 'de' THEN 'Unknown error' ELSE substr(text, 1, 1000) END AS failure_reason "
        "FROM documents",
    ),
}
