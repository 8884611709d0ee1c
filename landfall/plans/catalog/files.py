"""Queries that go through files in the shared folder: scans, splitting, whole runs."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from landfall.contract import Contract, FieldRule
from landfall.functions.crypto import key_column
from landfall.operators import audit
from landfall.operators.protect import decrypt_columns
from landfall.operators.splitting import (
    FIRST_IN_PARTITION,
    manifest_totals, needs_split, part_count, prepend_line, split_files, split_plan, wrap_partitions,
)
from landfall.plans.catalog.base import Query, day, feed, money, random_key, rendered, table
from landfall.plans.catalog.parsing import EVENT_JSON, FIXED_ORDERS, LINEITEM, fixed_width_lines, lineitem_lines
from landfall.plans.intake import IntakeJob, loaded_rows, read_landing, run_intake
from landfall.plans.workspace import shared_dir
from landfall.sources import read_feed
from landfall.sources.scan import scan_header_csv, scan_raw_lines
from landfall.streaming import land_new_files


def split_sizes(spark, sf_dir):
    return table(spark, sf_dir, "pages").selectExpr("page_id", "length(html) * 1000L AS bytes").selectExpr(
        "page_id", f"{needs_split('bytes')} AS split", f"{part_count('bytes')} AS parts"
    )


SPLIT_SIZES = """
WITH p AS (SELECT page_id, length(html) * 1000 AS bytes FROM pages)
SELECT page_id, bytes // 1024 > 5120 AS split,
       greatest(1, CAST(trunc(bytes / 1024::DOUBLE / 1024::DOUBLE + 0.999::DOUBLE) AS INT)) AS parts
FROM p"""


def split_listing(spark, sf_dir):
    """The same decision from a listing of files: customers as text, a file for each nation."""
    path = shared_dir(spark, "listed")
    lines = table(spark, sf_dir, "customer").selectExpr(
        "c_nationkey", "concat_ws(',', c_custkey, c_name, c_mktsegment) AS value"
    )
    lines.repartition("c_nationkey").write.partitionBy("c_nationkey").text(path)
    return split_plan(spark, path, threshold_kb=2, target_kb=1).selectExpr(
        "cast(regexp_extract(path, 'c_nationkey=([0-9]+)', 1) as int) AS nation", "length", "split", "parts"
    )


SPLIT_LISTING = """
WITH c AS (SELECT CAST(c_nationkey AS INT) AS nation,
                  CAST(sum(strlen(concat_ws(',', c_custkey, c_name, c_mktsegment)) + 1) AS BIGINT) AS length
           FROM customer GROUP BY 1)
SELECT nation, length, length // 1024 > 2 AS split,
       greatest(1, CAST(trunc(length / 1024::DOUBLE + 0.999::DOUBLE) AS INT)) AS parts
FROM c"""


ORDER_FIELDS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
ORDERS = feed(" ".join(ORDER_FIELDS))
ORDER_TEXTS = (
    "o_orderkey", "o_custkey", "o_orderstatus", f"{money('o_totalprice')} AS o_totalprice",
    f"{day('o_orderdate')} AS o_orderdate", "o_orderpriority",
)
ORDERS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM orders"""


def _typed_orders(parsed):
    return parsed.filter("_error IS NULL").selectExpr(
        "cast(o_orderkey as bigint) AS o_orderkey", "cast(o_custkey as bigint) AS o_custkey", *ORDER_FIELDS[2:]
    )


def _order_texts(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*ORDER_TEXTS)


def _write_csv(spark, sf_dir, path):
    line = "concat_ws(',', " + ", ".join(ORDER_FIELDS) + ") AS value"
    prepend_line(_order_texts(spark, sf_dir).selectExpr(line), ",".join(ORDER_FIELDS)).write.text(path)


def _write_xml(spark, sf_dir, path):
    cells = ", ".join(f"'<{c}>', {c}, '</{c}>\\n'" for c in ORDER_FIELDS)
    note = "'<note>up to /order></note>'"  # text that ends like the closing tag
    rows = _order_texts(spark, sf_dir).selectExpr(f"concat(' <order>\\n', {cells}, {note}, ' </order>') AS value")
    wrap_partitions(rows, '\n<?xml version="1.0" encoding="UTF-8"?>\n<orders>', "</orders>").write.text(path)


def _write_json_arrays(spark, sf_dir, path):
    pretty = "to_json(struct(*), map('pretty', 'true')) AS value"
    rows = _order_texts(spark, sf_dir).selectExpr(pretty).selectExpr(
        "replace(value, '\\n', '\\n  ') AS value"
    )
    listed = rows.selectExpr(f"concat(if({FIRST_IN_PARTITION}, '  ', ' ,'), value) AS value")
    wrap_partitions(listed, "[", "]").write.text(path)


def xml_files(spark, sf_dir):
    path = shared_dir(spark, "xml")
    _write_xml(spark, sf_dir, path)
    return _typed_orders(read_feed(spark, path, feed(" ".join(ORDER_FIELDS), format="XML", row_tag="order")))


def xml_markup_files(spark, sf_dir):
    """Row tags with attributes and blanks, closing tags inside CDATA, nested rows, and orders of one status commented out."""
    path = shared_dir(spark, "xml")
    cells = ", ".join(f"'<{c}>', {c}, '</{c}>'" for c in ORDER_FIELDS)
    note = "'<note><![CDATA[</order><order>]]></note><order><o_orderkey>0</o_orderkey></order>'"
    row = f"concat('<order', if(o_orderkey % 2 = 0, ' kind=\"a>b\"', ''), '>', {cells}, {note}, '</order', if(o_orderkey % 3 = 0, ' ', ''), '>')"
    rows = _order_texts(spark, sf_dir).selectExpr(f"if(o_orderstatus = 'P', concat('<!-- ', {row}, ' -->'), {row}) AS value")
    wrap_partitions(rows, "<?xml version='1.0'?><orders>", "</orders>").write.option("compression", "gzip").text(path)
    return _typed_orders(read_feed(spark, path, feed(" ".join(ORDER_FIELDS), format="XML", row_tag="order")))


def json_damaged_files(spark, sf_dir):
    """Arrays in which the orders of one status lack their last brace: each costs itself."""
    path = shared_dir(spark, "json")
    rows = _order_texts(spark, sf_dir).selectExpr(
        "concat(if(" + FIRST_IN_PARTITION + ", ' ', ','), if(o_orderstatus = 'P', rtrim('}', to_json(struct(*))), to_json(struct(*)))) AS value"
    )
    wrap_partitions(rows, "[", "]").write.text(path)
    parsed = read_feed(spark, path, feed(" ".join(ORDER_FIELDS), format="JSON", is_json_array=True))
    return parsed.groupBy(F.expr("_error.reason AS reason"), F.expr("_error IS NULL AND o_orderstatus <> 'P' AS good")).agg(
        F.count("*").alias("n_rows"), F.expr("coalesce(sum(cast(o_orderkey as bigint)), 0) AS keys")
    )


JSON_DAMAGED_FILES = """
SELECT CASE WHEN o_orderstatus = 'P' THEN 'malformed JSON' END AS reason, o_orderstatus <> 'P' AS good, count(*) AS n_rows,
       CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_orderkey END) AS BIGINT) AS keys
FROM orders GROUP BY ALL"""


def json_array_files(spark, sf_dir):
    path = shared_dir(spark, "json")
    _write_json_arrays(spark, sf_dir, path)
    return _typed_orders(read_feed(spark, path, feed(" ".join(ORDER_FIELDS), format="JSON", is_json_array=True)))


def json_array_chunks(spark, sf_dir):
    """The same files read without a whole-file parse, by the text that ends each element."""
    path = shared_dir(spark, "json")
    _write_json_arrays(spark, sf_dir, path)
    contract = feed(" ".join(ORDER_FIELDS), format="JSON", is_json_array=True, record_end="\n  }")
    return _typed_orders(read_feed(spark, path, contract))


def header_csv_scan(spark, sf_dir):
    path = shared_dir(spark, "csv")
    texts = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "concat(c_name, ', ', c_mktsegment) AS c_name", f"{money('c_acctbal')} AS c_acctbal"
    )
    texts.write.csv(path, header=True)
    return scan_header_csv(spark, path, feed("c_custkey c_name c_acctbal")).selectExpr(
        "cast(c_custkey as bigint) AS c_custkey", "c_name", "c_acctbal", "_corrupt AS corrupt"
    )


HEADER_CSV_SCAN = """
SELECT c_custkey, c_name || ', ' || c_mktsegment AS c_name,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal, CAST(NULL AS VARCHAR) AS corrupt
FROM customer"""


def raw_line_scan(spark, sf_dir):
    path = shared_dir(spark, "lines")
    _order_texts(spark, sf_dir).selectExpr("concat_ws(' ', " + ", ".join(ORDER_FIELDS) + ") AS value").write.text(path)
    return scan_raw_lines(spark, path)


RAW_LINE_SCAN = f"""
SELECT o_orderkey || ' ' || o_custkey || ' ' || o_orderstatus || ' ' || o_totalprice || ' ' || o_orderdate || ' '
       || o_orderpriority AS raw_line
FROM ({ORDERS_SQL})"""


def split_manifest(spark, sf_dir):
    """Rows and parts of a split, counted from the parts written."""
    src, out = shared_dir(spark, "csv"), shared_dir(spark, "parts")
    _write_csv(spark, sf_dir, src)
    manifest = split_files(spark, src, ORDERS, out, target_kb=64)
    return manifest_totals(manifest).selectExpr("total_rows", "part_count > 0 AS has_parts")


def split_bounded_parts(spark, sf_dir):
    """Parts of at most 700 rows, each with its header or root element, read again as their sources."""
    found = []
    for fmt in ("CSV", "XML"):
        src, out = shared_dir(spark, fmt.lower()), shared_dir(spark, "parts")
        if fmt == "XML":
            _write_xml(spark, sf_dir, src)
        else:
            _order_texts(spark, sf_dir).selectExpr("concat_ws(',', *) AS value").write.text(src)
        contract = feed(" ".join(ORDER_FIELDS), format=fmt, row_tag="order")
        manifest = split_files(spark, src, contract, out, target_kb=4096, root_tag="orders", max_rows=700)
        rows = read_feed(spark, out, contract).agg(F.count_if(F.col("_error").isNull()).alias("n_rows"), F.sum(F.col("o_orderkey").cast("long")).alias("keys"))
        sizes = manifest.agg(F.expr("max(rows) AS largest"), F.expr("sum(rows) AS total"))
        found.append(sizes.crossJoin(rows).select(F.lit(fmt).alias("format"), (F.col("largest") <= 700).alias("bounded"), "total", "n_rows", "keys"))
    return found[0].unionByName(found[1])


SPLIT_BOUNDED_PARTS = """
SELECT format, true AS bounded, count(*) AS total, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM orders, (VALUES ('CSV'), ('XML')) f(format) GROUP BY format"""


def split_csv_files(spark, sf_dir):
    src, out = shared_dir(spark, "csv"), shared_dir(spark, "parts")
    _write_csv(spark, sf_dir, src)
    split_files(spark, src, ORDERS, out, target_kb=64)
    return _typed_orders(read_feed(spark, out, ORDERS))


def split_xml_files(spark, sf_dir):
    src, out = shared_dir(spark, "xml"), shared_dir(spark, "parts")
    _write_xml(spark, sf_dir, src)
    contract = feed(" ".join(ORDER_FIELDS), format="XML", row_tag="order")
    split_files(spark, src, contract, out, target_kb=256, root_tag="orders")
    return _typed_orders(read_feed(spark, out, contract))


def split_json_files(spark, sf_dir):
    src, out = shared_dir(spark, "json"), shared_dir(spark, "parts")
    _write_json_arrays(spark, sf_dir, src)
    contract = feed(" ".join(ORDER_FIELDS), format="JSON", is_json_array=True)
    split_files(spark, src, contract, out, target_kb=256)
    lines = feed(" ".join(ORDER_FIELDS), format="JSON")
    return _typed_orders(read_feed(spark, out, lines))


SHIPMENTS = Contract(
    (
        *[FieldRule(n, required=True, type="bigint") for n in LINEITEM.names[:4]],
        FieldRule("l_quantity", required=True, type="decimal(18,2)"),
        FieldRule("l_extendedprice", required=True, max_length=8, encrypt="value", sensitive=True),
        FieldRule("l_discount", pattern=r"^0[.]0[0-9]$"),
        FieldRule("l_tax"),
        FieldRule("l_returnflag", required=True, allowed=("A", "N")),
        FieldRule("l_linestatus", min_length=1, max_length=1),
        FieldRule("l_shipdate", required=True, type="date"),
    ),
    target_table="stg_lineitem",
)


def _write_lineitem(spark, sf_dir, path):
    prepend_line(lineitem_lines(spark, sf_dir), ",".join(LINEITEM.names)).write.text(path)


def _land(spark, src, contract, control=None, key=None):
    """One whole run over the files under ``src``; the landing table and the run log."""
    out, log = shared_dir(spark, "table"), shared_dir(spark, "audit")
    run_intake(spark, IntakeJob([src], contract, out, log, control, key or random_key(), "run-1"))
    return out, audit.run_states(audit.read_events(spark, log))


def _outcomes(landed):
    return landed.groupBy("execution_id", "outcome", "error_type", "field", "reason").agg(F.count("*").alias("n_rows"))


def intake_outcomes(spark, sf_dir):
    """lineitem as delimited files through a whole run."""
    src = shared_dir(spark, "csv")
    _write_lineitem(spark, sf_dir, src)
    out, _ = _land(spark, src, SHIPMENTS)
    return _outcomes(read_landing(spark, out, SHIPMENTS))


INTAKE_OUTCOMES = """
WITH t AS (
    SELECT length(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)) AS n_price,
           CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) AS discount, l_returnflag FROM lineitem),
e AS (SELECT CASE WHEN n_price > 8 THEN 'l_extendedprice' WHEN NOT regexp_matches(discount, '^0[.]0[0-9]$')
                  THEN 'l_discount' WHEN l_returnflag NOT IN ('A', 'N') THEN 'l_returnflag' END AS field, n_price FROM t)
SELECT 'run-1' AS execution_id, CASE WHEN field IS NULL THEN 'valid' ELSE 'error' END AS outcome,
       CASE WHEN field IS NOT NULL THEN 'VALIDATION_ERROR' END AS error_type, field,
       CASE field WHEN 'l_extendedprice' THEN 'length ' || n_price || ' outside 0..8'
                  WHEN 'l_discount' THEN 'does not match the pattern' WHEN 'l_returnflag' THEN 'not one of A/N' END AS reason,
       count(*) AS n_rows
FROM e GROUP BY ALL"""


def intake_split(spark, sf_dir):
    """The same run with files that are split into parts first."""
    src, out = shared_dir(spark, "csv"), shared_dir(spark, "table")
    _write_lineitem(spark, sf_dir, src)
    job = IntakeJob([src], SHIPMENTS, out, shared_dir(spark, "audit"), None, random_key(), "run-1", split_above_kb=1, part_kb=512)
    run_intake(spark, job)
    return _outcomes(read_landing(spark, out, SHIPMENTS))


def intake_state(spark, sf_dir):
    """The same with a control file that counts all rows, so that the run fails by the rejected ones."""
    src, control = shared_dir(spark, "csv"), shared_dir(spark, "control")
    _write_lineitem(spark, sf_dir, src)
    stated = table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n")).selectExpr("concat('record_count=', n) AS value")
    stated.write.text(control)
    _, states = _land(spark, src, SHIPMENTS, control)
    return states.selectExpr(
        "execution_id", "status", "actual_count", "expected_count", "failure_reason", "file_type", "target_table"
    )


INTAKE_STATE = """
WITH n AS (SELECT count(*) AS x,
       count(*) FILTER (WHERE length(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)) <= 8
           AND regexp_matches(CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR), '^0[.]0[0-9]$')
           AND l_returnflag IN ('A', 'N')) AS n
FROM lineitem)
SELECT 'run-1' AS execution_id, 'FAILED' AS status, n AS actual_count, x AS expected_count,
       'Record count mismatch! Expected: ' || x || ', Actual: ' || n || ', Difference: ' || (n - x) AS failure_reason,
       'CSV' AS file_type, 'stg_lineitem' AS target_table
FROM n"""

ACTIVITY = Contract(
    (
        FieldRule("event_type", required=True), FieldRule("value", type="double"),
        FieldRule("user_id", required=True, encrypt="value"), FieldRule("props"),
    ),
    format="JSON",
)


def intake_json(spark, sf_dir):
    src = shared_dir(spark, "json")
    rendered(table(spark, sf_dir, "events"), EVENT_JSON).write.text(src)
    out, _ = _land(spark, src, ACTIVITY)
    return _outcomes(read_landing(spark, out, ACTIVITY))


INTAKE_JSON = """
WITH e AS (SELECT CASE WHEN event_type = 'error' AND value < 20 THEN 'PARSE_ERROR'
                       WHEN event_type IN ('view', 'signup') THEN 'VALIDATION_ERROR' END AS error_type, event_type FROM events)
SELECT 'run-1' AS execution_id, CASE WHEN error_type IS NULL THEN 'valid' ELSE 'error' END AS outcome, error_type,
       CASE error_type WHEN 'PARSE_ERROR' THEN '' WHEN 'VALIDATION_ERROR' THEN 'user_id' END AS field,
       CASE WHEN error_type = 'PARSE_ERROR' THEN 'malformed JSON' WHEN event_type = 'view' THEN 'missing'
            WHEN event_type = 'signup' THEN 'null' END AS reason, count(*) AS n_rows
FROM e GROUP BY ALL"""


def intake_decrypted(spark, sf_dir):
    """What was landed encrypted, read back with the key."""
    src, secret = shared_dir(spark, "json"), random_key()
    rendered(table(spark, sf_dir, "events"), EVENT_JSON).write.text(src)
    out, _ = _land(spark, src, ACTIVITY, key=secret)
    rows = decrypt_columns(loaded_rows(spark, out, ACTIVITY), ["user_id_encrypted"], key_column(spark, secret))
    return rows.selectExpr(
        "event_type", "cast(value as double) AS amount", "props", "cast(user_id_encrypted as bigint) AS user_id"
    )


INTAKE_DECRYPTED = """
SELECT event_type, value AS amount, replace(props, ' ', '') AS props, user_id FROM events
WHERE event_type NOT IN ('view', 'signup') AND NOT (event_type = 'error' AND value < 20)"""


SECRETS = Contract(
    (
        FieldRule("event_type", required=True),
        *[FieldRule(n, encrypt="value", sensitive=True) for n in ("value", "user_id", "props")],
    ),
    format="JSON",
)


def intake_secrets(spark, sf_dir):
    """Numbers, absent and null values and objects without a phone, landed encrypted and read back."""
    src, secret = shared_dir(spark, "json"), random_key()
    rendered(table(spark, sf_dir, "events"), EVENT_JSON).write.text(src)
    out, _ = _land(spark, src, SECRETS, key=secret)
    landed = loaded_rows(spark, out, SECRETS)
    sealed = [f.warehouse_name for f in SECRETS.encrypted]
    # A JSON object or a number with its point is not the Base64 of anything.
    clear = landed.withColumn("in_clear", F.expr(" OR ".join(f"rlike({c}, '[{{.]')" for c in sealed)))
    return decrypt_columns(clear, sealed, key_column(spark, secret)).selectExpr(
        "event_type", "cast(value_encrypted as double) AS amount", "props_encrypted AS props",
        "cast(nullif(user_id_encrypted, ' ') as bigint) AS user_id", "in_clear",
    )


INTAKE_SECRETS = """
SELECT event_type, value AS amount, replace(props, ' ', '') AS props,
       CASE WHEN event_type NOT IN ('view', 'signup') THEN user_id END AS user_id, false AS in_clear
FROM events WHERE NOT (event_type = 'error' AND value < 20)"""

QUOTED = Contract(
    (
        FieldRule("c_custkey", required=True, type="bigint"), FieldRule("c_name", required=True),
        FieldRule("c_acctbal", required=True, type="decimal(18,2)"),
    ),
    quote='"',
)


def intake_quoted(spark, sf_dir):
    """Delimiters, quotes and line ends inside quoted values; one market segment lacks its last value, one has a quote too many."""
    src = shared_dir(spark, "csv")
    lines = rendered(
        table(spark, sf_dir, "customer"),
        "concat(c_custkey, ',\"', c_name, if(c_custkey % 3 = 0, '\\r\\n', if(c_custkey % 3 = 1, '\\n\\n', ', ')), '\"\"', c_mktsegment, '\"\"\"', "
        "if(c_mktsegment = 'FURNITURE', 'x\"', ''), "
        f"CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE concat(',', {money('c_acctbal')}) END)",
    )
    prepend_line(lines, ",".join(f'"{n}"' for n in QUOTED.names)).write.text(src)
    out, _ = _land(spark, src, QUOTED)
    return read_landing(spark, out, QUOTED).selectExpr(
        "cast(c_custkey as bigint) AS c_custkey", "c_name", "c_acctbal", "outcome", "field", "reason"
    )


INTAKE_QUOTED = """
WITH c AS (SELECT *, c_mktsegment = 'BUILDING' AS bad, c_mktsegment = 'FURNITURE' AS torn FROM customer)
SELECT CASE WHEN NOT bad AND NOT torn THEN c_custkey END AS c_custkey,
       CASE WHEN NOT bad AND NOT torn THEN c_name || CASE c_custkey % 3 WHEN 0 THEN chr(13) || chr(10) WHEN 1 THEN chr(10) || chr(10) ELSE ', ' END
           || '"' || c_mktsegment || '"' END AS c_name,
       CASE WHEN NOT bad AND NOT torn THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS c_acctbal,
       CASE WHEN bad OR torn THEN 'error' ELSE 'valid' END AS outcome,
       CASE WHEN bad THEN 'c_acctbal' WHEN torn THEN '' END AS field, CASE WHEN bad THEN 'missing' WHEN torn THEN 'unbalanced quote' END AS reason
FROM c"""


def intake_xml(spark, sf_dir):
    src = shared_dir(spark, "xml")
    _write_xml(spark, sf_dir, src)
    contract = Contract(
        tuple(
            FieldRule(n, required=True, encrypt="value" if n == "o_totalprice" else None,
                      allowed=("F", "O") if n == "o_orderstatus" else ())
            for n in ORDER_FIELDS
        ),
        format="XML", row_tag="order",
    )
    out, _ = _land(spark, src, contract)
    return _outcomes(read_landing(spark, out, contract))


INTAKE_XML = """
SELECT 'run-1' AS execution_id, CASE WHEN bad THEN 'error' ELSE 'valid' END AS outcome,
       CASE WHEN bad THEN 'VALIDATION_ERROR' END AS error_type, CASE WHEN bad THEN 'o_orderstatus' END AS field,
       CASE WHEN bad THEN 'not one of F/O' END AS reason, count(*) AS n_rows
FROM (SELECT o_orderstatus NOT IN ('F', 'O') AS bad FROM orders) GROUP BY ALL"""


def intake_fixed_width(spark, sf_dir):
    src = shared_dir(spark, "fixed")
    fixed_width_lines(spark, sf_dir).write.text(src)
    contract = replace(FIXED_ORDERS, fields=tuple(FieldRule(n, required=True) for n in FIXED_ORDERS.names))
    out, _ = _land(spark, src, contract)
    return _outcomes(read_landing(spark, out, contract))


INTAKE_FIXED_WIDTH = """
SELECT 'run-1' AS execution_id, CASE WHEN bad THEN 'error' ELSE 'valid' END AS outcome,
       CASE WHEN bad THEN 'VALIDATION_ERROR' END AS error_type, CASE WHEN bad THEN 'o_orderpriority' END AS field,
       CASE WHEN bad THEN 'empty' END AS reason, count(*) AS n_rows
FROM (SELECT o_orderstatus = 'P' AS bad FROM orders) GROUP BY ALL"""


def folder_stream(spark, sf_dir):
    """lineitem files picked up from a folder as a stream; runs are named after micro-batches."""
    src, out = shared_dir(spark, "csv"), shared_dir(spark, "table")
    _write_lineitem(spark, sf_dir, src)
    query = land_new_files(spark, src, SHIPMENTS, out, "run", shared_dir(spark, "stream"), random_key())
    query.awaitTermination()
    return read_landing(spark, out, SHIPMENTS).groupBy("outcome", "error_type", "field").agg(F.count("*").alias("n_rows"))


FOLDER_STREAM = f"""
SELECT outcome, error_type, field, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM ({INTAKE_OUTCOMES}) GROUP BY ALL"""

def intake_reruns(spark, sf_dir):
    """Runs that are tried again: one whose second attempt breaks, and one that is replaced."""
    src, out, log = shared_dir(spark, "csv"), shared_dir(spark, "table"), shared_dir(spark, "audit")
    lines = table(spark, sf_dir, "customer").selectExpr("concat_ws(',', c_custkey, c_name, c_mktsegment) AS value", "c_mktsegment")
    lines.select("value").write.text(f"{src}/all")
    lines.filter("c_mktsegment = 'BUILDING'").select("value").write.text(f"{src}/some")
    contract = feed("c_custkey c_name c_mktsegment", has_header=False)
    job = IntakeJob([f"{src}/all"], contract, out, log, execution_id="kept")
    run_intake(spark, job)
    try:
        run_intake(spark, replace(job, paths=[f"{src}/gone"], started=datetime.now(timezone.utc)))
    except AnalysisException:
        pass  # the log says so
    for part in ("all", "some"):
        run_intake(spark, replace(job, paths=[f"{src}/{part}"], execution_id="replaced", started=datetime.now(timezone.utc)))
    rows = loaded_rows(spark, out, contract).groupBy("execution_id").agg(F.count("*").alias("n_rows"))
    states = audit.run_states(audit.read_events(spark, log)).select("execution_id", "status", "actual_count", "failure_reason")
    tries = audit.attempt_states(audit.read_events(spark, log)).groupBy("execution_id").agg(
        F.count("*").alias("attempts"), F.count_if(F.col("status") == "FAILED").alias("failed")
    )
    return rows.join(states, "execution_id").join(tries, "execution_id")


INTAKE_RERUNS = """
SELECT 'kept' AS execution_id, count(*) AS n_rows, 'PASSED' AS status, count(*) AS actual_count, NULL::VARCHAR AS failure_reason, 2 AS attempts, 1 AS failed
FROM customer
UNION ALL SELECT 'replaced', count(*), 'PASSED', count(*), NULL, 2, 0 FROM customer WHERE c_mktsegment = 'BUILDING'"""


def stream_log(spark, sf_dir):
    """The log of a stream whose batches are runs: one does not have the rows it was told to, one aborts and is tried again."""
    src, out, log, told = (shared_dir(spark, n) for n in ("csv", "table", "audit", "control"))
    lines = table(spark, sf_dir, "orders").selectExpr("o_orderstatus", "concat_ws(',', o_orderkey, o_orderpriority) AS value")
    counts = {r.o_orderstatus: r["count"] for r in lines.groupBy("o_orderstatus").count().collect()}
    for status, n in counts.items():
        lines.filter(F.col("o_orderstatus") == status).select("value").coalesce(1).write.text(f"{src}/{status}")
        spark.range(1).select(F.lit(f"record_count={n + (status == 'F')}").alias("value")).coalesce(1).write.text(f"{told}/{status}")
    broken = {"O"}

    def control_of(paths):
        status = paths[0].split("/")[-2]
        if status in broken:
            broken.discard(status)
            raise OSError("no control file yet")
        return f"{told}/{status}"

    contract, checkpoint = feed("o_orderkey o_orderpriority", has_header=False), shared_dir(spark, "stream")
    for _ in range(2):
        query = land_new_files(spark, f"{src}/*", contract, out, "batch", checkpoint, files_per_batch=1, audit_dir=log, control_of=control_of)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            pass  # the second start goes on with the batch that aborted
    states = audit.run_states(audit.read_events(spark, log))
    tries = audit.attempt_states(audit.read_events(spark, log)).groupBy("execution_id").agg(F.count("*").alias("attempts"))
    landed = read_landing(spark, out, contract).groupBy("execution_id").agg(F.count("*").alias("n_rows"))
    return states.join(landed, "execution_id").join(tries, "execution_id").selectExpr(
        "regexp_extract(file_path, '/([A-Z])/part', 1) AS o_orderstatus", "status", "expected_count", "actual_count", "failure_reason", "n_rows",
        "attempts",
    )


STREAM_LOG = """
SELECT o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'PASSED' END AS status,
       count(*) + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS expected_count, count(*) AS actual_count,
       CASE WHEN o_orderstatus = 'F' THEN 'Record count mismatch! Expected: ' || (count(*) + 1) || ', Actual: ' || count(*) || ', Difference: -1' END
           AS failure_reason, count(*) AS n_rows, CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS attempts
FROM orders GROUP BY o_orderstatus"""

CATALOG = {
    "xml_markup_files": Query(xml_markup_files, f"SELECT * FROM ({ORDERS_SQL}) WHERE o_orderstatus <> 'P'"),
    "json_damaged_files": Query(json_damaged_files, JSON_DAMAGED_FILES),
    "intake_reruns": Query(intake_reruns, INTAKE_RERUNS),
    "stream_log": Query(stream_log, STREAM_LOG),
    "split_sizes": Query(split_sizes, SPLIT_SIZES),
    "split_listing": Query(split_listing, SPLIT_LISTING),
    "xml_files": Query(xml_files, ORDERS_SQL),
    "json_array_files": Query(json_array_files, ORDERS_SQL),
    "json_array_chunks": Query(json_array_chunks, ORDERS_SQL),
    "header_csv_scan": Query(header_csv_scan, HEADER_CSV_SCAN),
    "raw_line_scan": Query(raw_line_scan, RAW_LINE_SCAN),
    "split_manifest": Query(split_manifest, "SELECT count(*) AS total_rows, true AS has_parts FROM orders"),
    "split_bounded_parts": Query(split_bounded_parts, SPLIT_BOUNDED_PARTS),
    "split_csv_files": Query(split_csv_files, ORDERS_SQL),
    "split_xml_files": Query(split_xml_files, ORDERS_SQL),
    "split_json_files": Query(split_json_files, ORDERS_SQL),
    "intake_outcomes": Query(intake_outcomes, INTAKE_OUTCOMES),
    "intake_split": Query(intake_split, INTAKE_OUTCOMES),
    "intake_state": Query(intake_state, INTAKE_STATE),
    "intake_json": Query(intake_json, INTAKE_JSON),
    "intake_decrypted": Query(intake_decrypted, INTAKE_DECRYPTED),
    "intake_secrets": Query(intake_secrets, INTAKE_SECRETS),
    "intake_quoted": Query(intake_quoted, INTAKE_QUOTED),
    "intake_xml": Query(intake_xml, INTAKE_XML),
    "intake_fixed_width": Query(intake_fixed_width, INTAKE_FIXED_WIDTH),
    "folder_stream": Query(folder_stream, FOLDER_STREAM),
}
