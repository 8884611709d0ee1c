"""Quality rules, routing and the texts of errors."""

from __future__ import annotations

from landfall.contract import Contract, FieldRule, Policy
from landfall.functions.errors import NO_ERROR, humanize
from landfall.functions.text import utf16_length
from landfall.operators.quality import required_error, validate, value_error
from landfall.operators.routing import error_report, is_envelope, read_envelopes, route_counts
from landfall.plans.catalog.base import Query, money, rendered, table
from landfall.sources import parse_feed

UNPARSED = ("cast(NULL as array<string>) AS _missing", f"{NO_ERROR} AS _error")

NAME = (
    "CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_acctbal >= 0 THEN c_name "
    "WHEN c_mktsegment = 'MACHINERY' THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' THEN ' ' ELSE c_name END"
)
SEGMENT = "CASE WHEN c_nationkey = 3 THEN NULL WHEN c_nationkey IN (4, 5) THEN '' ELSE c_mktsegment END"


def required_check(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"{NAME} AS name", f"{SEGMENT} AS segment", *UNPARSED
    )
    contract = Contract((FieldRule("name", required=True), FieldRule("segment", required=True)))
    return rows.selectExpr("c_custkey", f"{required_error(rows, contract)} AS e").selectExpr(
        "c_custkey", "e.field AS field", "e.reason AS reason"
    )


REQUIRED_CHECK = f"""
WITH c AS (SELECT c_custkey, {NAME} AS name, {SEGMENT} AS segment FROM customer)
SELECT c_custkey,
       CASE WHEN name IS NULL OR trim(name) = '' THEN 'name'
            WHEN segment IS NULL OR trim(segment) = '' THEN 'segment' END AS field,
       CASE WHEN name IS NULL THEN 'null' WHEN trim(name) = '' THEN 'empty'
            WHEN segment IS NULL THEN 'null' WHEN trim(segment) = '' THEN 'empty' END AS reason
FROM c"""

STAFF_LINE = (
    "CASE WHEN c_mktsegment = 'BUILDING' THEN ', ,\t,,' "
    "WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN concat(c_custkey, ',,', c_name, ',', c_nationkey, ',') "
    "WHEN c_mktsegment = 'MACHINERY' THEN concat(',', c_name, ',x') "
    "WHEN c_mktsegment = 'FURNITURE' THEN ' ' "
    "WHEN c_nationkey < 5 THEN concat(c_custkey, ',', c_name) "
    "WHEN c_nationkey > 20 THEN concat(c_custkey, ',', c_name, ',java; sql,5 Elm, Ulm') "
    "ELSE concat(c_custkey, ',', c_name, ',java; sql,', c_mktsegment) END"
)


def _staff(policy: Policy) -> Contract:
    return Contract(
        (
            FieldRule("id", required=True, max_length=20),
            FieldRule("name", required=True, min_length=3),
            FieldRule("skills", required=True, shape="list"),
            FieldRule("address", required=True, shape="object"),
        ),
        has_header=False, policy=policy,
    )


def _staff_lines(spark, sf_dir):
    return rendered(table(spark, sf_dir, "customer"), STAFF_LINE, "c_custkey")


def _checked(spark, sf_dir, policy):
    contract = _staff(policy)
    return validate(parse_feed(_staff_lines(spark, sf_dir), contract), contract).selectExpr(
        "c_custkey", "_error.type AS error_type", "_error.field AS field", "_error.reason AS reason"
    )


def strict_rules(spark, sf_dir):
    return _checked(spark, sf_dir, Policy())


def lenient_rules(spark, sf_dir):
    return _checked(spark, sf_dir, Policy.lenient())


STRICT_RULES = """
SELECT c_custkey,
       CASE WHEN c_mktsegment IN ('BUILDING') THEN 'PARSE_ERROR'
            WHEN c_mktsegment = 'FURNITURE' THEN 'BLANK_ROW'
            WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN 'PARSE_ERROR'
            WHEN c_mktsegment = 'MACHINERY' OR c_nationkey < 5 THEN 'VALIDATION_ERROR'
            WHEN c_nationkey > 20 THEN 'PARSE_ERROR' END AS error_type,
       CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN ''
            WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN ''
            WHEN c_mktsegment = 'MACHINERY' THEN 'id' WHEN c_nationkey < 5 THEN 'skills'
            WHEN c_nationkey > 20 THEN '' END AS field,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '5 values for 4 fields' WHEN c_mktsegment = 'FURNITURE' THEN ''
            WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN '5 values for 4 fields'
            WHEN c_mktsegment = 'MACHINERY' THEN 'empty' WHEN c_nationkey < 5 THEN 'missing'
            WHEN c_nationkey > 20 THEN '5 values for 4 fields' END AS reason
FROM customer"""

LENIENT_RULES = """
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'VALIDATION_ERROR' WHEN c_mktsegment = 'FURNITURE' THEN 'BLANK_ROW'
            WHEN c_mktsegment = 'MACHINERY' THEN 'VALIDATION_ERROR' END AS error_type,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'id' WHEN c_mktsegment = 'FURNITURE' THEN ''
            WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN 'name'
            WHEN c_mktsegment = 'MACHINERY' THEN 'id' END AS field,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN '' WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'empty' END
           AS reason
FROM customer"""


def blank_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_acctbal < 0 THEN ' ' ELSE cast(c_nationkey as string) END AS nation",
        "CASE WHEN c_acctbal < 5000 THEN array('', ' ') ELSE array(c_name) END AS names",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE named_struct('raw', "
        "CASE WHEN c_acctbal < 1000 THEN '' ELSE c_mktsegment END) END AS place",
        *UNPARSED,
    )
    strict = Contract(tuple(FieldRule(n, required=True) for n in ("nation", "names", "place")))
    lenient = strict.with_policy(Policy.lenient())
    both = validate(rows, strict).selectExpr("* EXCEPT (_error)", "_error AS _strict", f"{NO_ERROR} AS _error")
    return validate(both, lenient).selectExpr(
        "c_custkey", "coalesce(_strict.type = 'BLANK_ROW', false) AS strict_blank",
        "coalesce(_error.type = 'BLANK_ROW', false) AS lenient_blank",
    )


BLANK_ROWS = "SELECT c_custkey, c_acctbal < 0 AS strict_blank, false AS lenient_blank FROM customer"


def missing_fields(spark, sf_dir):
    lines = rendered(
        table(spark, sf_dir, "events"),
        "concat('{\"kind\": \"', event_type, '\"', CASE event_type WHEN 'view' THEN '' "
        "WHEN 'click' THEN ', \"k\": null' WHEN 'signup' THEN ', \"k\": \" \"' "
        "ELSE concat(', \"k\": ', event_id) END, '}')",
        "event_id",
    )
    strict = Contract((FieldRule("kind", required=True), FieldRule("k", required=True)), format="JSON")
    lenient = strict.with_policy(Policy.lenient())
    parsed = parse_feed(lines, strict)
    return parsed.selectExpr(
        "event_id", f"{required_error(parsed, strict)} AS s", f"{required_error(parsed, lenient)} AS l"
    ).selectExpr("event_id", "s.reason AS strict_reason", "l.reason AS lenient_reason")


MISSING_FIELDS = """
SELECT event_id, CASE event_type WHEN 'view' THEN 'missing' WHEN 'click' THEN 'null' WHEN 'signup' THEN 'empty' END
       AS strict_reason,
       CASE event_type WHEN 'click' THEN 'null' WHEN 'signup' THEN 'empty' END AS lenient_reason
FROM events"""


def length_rules(spark, sf_dir):
    """The rule as a run checks it; texts of one source are null."""
    texts = table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS id", "CASE WHEN source <> 'src0' THEN text END AS text"
    ).unionByName(table(spark, sf_dir, "conversations").selectExpr("-1 - (conv_id * 1000 + turn) AS id", "text"))
    contract = Contract((FieldRule("id", required=True), FieldRule("text", min_length=200, max_length=3000)))
    checked = validate(texts.selectExpr("*", *UNPARSED), contract)
    return checked.selectExpr("id", f"{utf16_length('text')} AS units", "_error.reason AS reason")


LENGTH_RULES = r"""
WITH t AS (SELECT doc_id AS id, CASE WHEN source <> 'src0' THEN text END AS text FROM documents
           UNION ALL SELECT -1 - (conv_id * 1000 + turn), text FROM conversations),
u AS (SELECT id, length(text) + length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g')) AS units FROM t)
SELECT id, units, CASE WHEN units IS NULL OR units NOT BETWEEN 200 AND 3000
       THEN 'length ' || coalesce(CAST(units AS VARCHAR), 'of null') || ' outside 200..3000' END AS reason
FROM u"""


def storage_constraints(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name", "CASE WHEN p_size > 45 THEN NULL ELSE p_brand END AS p_brand", "p_type", *UNPARSED
    )
    contract = Contract((
        FieldRule("p_name", width=8),
        FieldRule("p_brand", not_null=True),
        FieldRule("p_type", allowed=("ECONOMY", "SMALL", "LARGE")),
    ))
    return rows.selectExpr("p_partkey", f"{value_error(rows, contract)} AS e").selectExpr(
        "p_partkey", "e.field AS field", "e.reason AS reason"
    )


STORAGE_CONSTRAINTS = """
SELECT p_partkey,
       CASE WHEN length(p_name) > 8 THEN 'p_name' WHEN p_size > 45 THEN 'p_brand'
            WHEN p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE') THEN 'p_type' END AS field,
       CASE WHEN length(p_name) > 8 THEN 'longer than VARCHAR(8)' WHEN p_size > 45 THEN 'null in a NOT NULL column'
            WHEN p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE') THEN 'not one of ECONOMY/SMALL/LARGE' END AS reason
FROM part"""

BALANCE = "CASE WHEN c_nationkey < 5 THEN 'n/a' WHEN c_nationkey < 8 THEN '' ELSE {} END"
CODE = "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN concat(c_name, 'x') ELSE c_name END"


def type_pattern_rules(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"{BALANCE.format(money('c_acctbal'))} AS balance", f"{CODE} AS code", *UNPARSED
    )
    contract = Contract((
        FieldRule("balance", type="decimal(6,2)"), FieldRule("code", pattern=r"^Customer#[0-9]{9}$"),
    ))
    return rows.selectExpr("c_custkey", f"{value_error(rows, contract)} AS e").selectExpr(
        "c_custkey", "e.field AS field", "e.reason AS reason"
    )


TYPE_PATTERN_RULES = f"""
WITH c AS (SELECT c_custkey, {BALANCE.format('CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)')} AS balance,
                  {CODE} AS code FROM customer),
r AS (SELECT c_custkey, balance <> '' AND try_cast(balance AS DECIMAL(6,2)) IS NULL AS bad_type,
             NOT regexp_matches(code, '^Customer#[0-9]{{9}}$') AS bad_code FROM c)
SELECT c_custkey, CASE WHEN bad_type THEN 'balance' WHEN bad_code THEN 'code' END AS field,
       CASE WHEN bad_type THEN 'not a decimal(6,2)' WHEN bad_code THEN 'does not match the pattern' END AS reason
FROM r"""


def error_routing(spark, sf_dir):
    contract = _staff(Policy.lenient())
    rows = validate(parse_feed(_staff_lines(spark, sf_dir), contract), contract)
    return route_counts(rows)


ERROR_ROUTING = f"""
WITH r AS ({LENIENT_RULES})
SELECT coalesce(error_type, 'valid') AS outcome, coalesce(field, '') AS field, count(*) AS n FROM r GROUP BY 1, 2"""

KIND = "CASE lang WHEN 'de' THEN 'PARSE_ERROR' WHEN 'fr' THEN 'BLANK_ROW' ELSE 'VALIDATION_ERROR' END"
FIELD = "CASE WHEN lang IN ('de', 'fr') THEN '' WHEN source = 'src0' THEN '' ELSE lang END"
REASON = (
    "CASE WHEN source IN ('src1', 'src2') THEN 'empty' WHEN source IN ('src3', 'src4') THEN 'null' "
    "WHEN source = 'src5' THEN 'json_parse_failed:bad token' ELSE source END"
)


def error_messages(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", f"{KIND} AS kind", f"{FIELD} AS field", f"{REASON} AS reason", "text"
    ).selectExpr("*", f"{humanize('kind', 'field', 'reason')} AS message")
    block = error_report("'2026-01-01T00:00:00Z'", "kind", "''", "field", "message", "text")
    return rows.selectExpr("doc_id", f"{block} AS report")


MESSAGE = """CASE WHEN kind = 'BLANK_ROW' THEN 'Row is empty - all required fields are blank'
    WHEN kind = 'PARSE_ERROR' THEN 'Could not parse the row: ' || reason
    WHEN field = '' THEN 'Validation failed: ' || reason
    WHEN reason = 'empty' THEN 'Required field ''' || field || ''' is empty - cannot be blank'
    WHEN reason = 'null' THEN 'Required field ''' || field || ''' is null'
    WHEN reason LIKE 'json_parse_failed:%' THEN 'Row is not valid JSON: ' || substr(reason, 19)
    ELSE 'Field ''' || field || ''' validation failed: ' || reason END"""

ERROR_MESSAGES = f"""
WITH r AS (SELECT doc_id, {KIND} AS kind, {FIELD} AS field, {REASON} AS reason, text FROM documents),
m AS (SELECT *, {MESSAGE} AS message FROM r)
SELECT doc_id, 'Timestamp     : 2026-01-01T00:00:00Z' || chr(10) || 'Error Type    : ' || kind || chr(10)
    || CASE WHEN field <> '' THEN 'Field         : ' || field || chr(10) ELSE '' END
    || 'Message       : ' || message || chr(10) || 'Data          : '
    || CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS report
FROM m"""

ENVELOPE = (
    "CASE WHEN source IN ('src0', 'src1') THEN concat('PARSE_ERROR|csv|', lang, '|', text) "
    "WHEN source IN ('src2', 'src3') THEN concat('VALIDATION_ERROR|warehouse|', lang, '|empty|', text) "
    "WHEN source IN ('src4', 'src5') THEN concat('ERROR|', lang, '|', text) "
    "WHEN source IN ('src6', 'src7') THEN concat('BLANK|', text) "
    "WHEN source IN ('src8', 'src9') THEN concat('PARSE_ERROR|', lang) ELSE text END"
)


def error_envelopes(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{ENVELOPE} AS line")
    return read_envelopes(lines, "line", "e").selectExpr(
        "doc_id", f"{is_envelope('line')} AS is_error", "e.type AS type", "e.stage AS stage", "e.field AS field",
        "e.message AS message", "e.data AS data",
    )


ERROR_ENVELOPES = f"""
WITH l AS (SELECT doc_id, lang, source, {ENVELOPE} AS line FROM documents),
p AS (SELECT *, string_split(line, '|') AS p FROM l),
k AS (SELECT *, CASE WHEN p[1] = 'PARSE_ERROR' AND len(p) >= 4 THEN 1 WHEN p[1] = 'VALIDATION_ERROR' AND len(p) >= 5
             THEN 2 WHEN p[1] = 'ERROR' AND len(p) >= 3 THEN 3 WHEN p[1] = 'BLANK' AND len(p) >= 2 THEN 4 END AS k FROM p)
SELECT doc_id, regexp_matches(line, '^(PARSE_ERROR|VALIDATION_ERROR|ERROR|BLANK)\\|') AS is_error,
       CASE k WHEN 1 THEN 'PARSE_ERROR' WHEN 2 THEN 'VALIDATION_ERROR' WHEN 3 THEN 'ERROR' WHEN 4 THEN 'BLANK_ROW'
              ELSE 'UNKNOWN' END AS type,
       CASE WHEN k <= 2 THEN p[2] ELSE '' END AS stage, CASE k WHEN 2 THEN p[3] ELSE '' END AS field,
       CASE k WHEN 1 THEN 'Could not parse the row: ' || p[3]
              WHEN 2 THEN 'Required field ''' || p[3] || ''' is empty - cannot be blank' WHEN 3 THEN p[2]
              WHEN 4 THEN 'Row is empty - all required fields are blank' ELSE line END AS message,
       CASE k WHEN 1 THEN p[4] WHEN 2 THEN p[5] WHEN 3 THEN p[3] WHEN 4 THEN p[2] ELSE '' END AS data
FROM k"""

CATALOG = {
    "required_check": Query(required_check, REQUIRED_CHECK),
    "strict_rules": Query(strict_rules, STRICT_RULES),
    "lenient_rules": Query(lenient_rules, LENIENT_RULES),
    "blank_rows": Query(blank_rows, BLANK_ROWS),
    "missing_fields": Query(missing_fields, MISSING_FIELDS),
    "length_rules": Query(length_rules, LENGTH_RULES),
    "storage_constraints": Query(storage_constraints, STORAGE_CONSTRAINTS),
    "type_pattern_rules": Query(type_pattern_rules, TYPE_PATTERN_RULES),
    "error_routing": Query(error_routing, ERROR_ROUTING),
    "error_messages": Query(error_messages, ERROR_MESSAGES),
    "error_envelopes": Query(error_envelopes, ERROR_ENVELOPES),
}
