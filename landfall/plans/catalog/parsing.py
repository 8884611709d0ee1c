"""Parsers: text in four formats to columns."""

from __future__ import annotations

from dataclasses import replace

from landfall.contract import FieldRule, FixedColumn, Policy
from landfall.functions.text import base_name, json_quote, replace_null_tokens
from landfall.operators.enrich import cleanse_nulls
from landfall.plans.catalog.base import Query, day, feed, money, rendered, table
from landfall.sources import parse_feed
from landfall.sources.json_records import json_documents, parse_json_records
from landfall.sources.xml_rows import chunks_of_documents, parse_xml_fragments, row_fragments

LINEITEM = feed(
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
)


def lineitem_lines(spark, sf_dir):
    amounts = ", ".join(money(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    line = (
        f"concat_ws(',', l_orderkey, l_partkey, l_suppkey, l_linenumber, {amounts}, "
        f"l_returnflag, l_linestatus, {day('l_shipdate')})"
    )
    return rendered(table(spark, sf_dir, "lineitem"), line)


def delimited_parse(spark, sf_dir):
    return parse_feed(lineitem_lines(spark, sf_dir), LINEITEM).filter("_error IS NULL").selectExpr(
        *[f"cast({c} as bigint) AS {c}" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )


DELIMITED_PARSE = """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS l_quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS l_extendedprice,
       CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) AS l_discount,
       CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR) AS l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem"""


def delimited_header_blank(spark, sf_dir):
    lines = rendered(
        table(spark, sf_dir, "orders"),
        "CASE WHEN o_orderstatus = 'P' AND o_totalprice > 300000 THEN 'o_orderkey;o_custkey;o_orderstatus' "
        "WHEN o_orderstatus = 'F' AND o_totalprice < 100000 THEN ' \\t ' "
        "ELSE concat_ws(';', o_orderkey, o_custkey, o_orderstatus) END",
        "o_orderpriority",
    )
    contract = feed("o_orderkey o_custkey o_orderstatus", delimiter=";")
    return (
        parse_feed(lines, contract)
        .groupBy("o_orderpriority")
        .agg({"*": "count", "_error": "count"})
        .selectExpr("o_orderpriority", "`count(1)` AS n_rows", "`count(_error)` AS n_blank")
    )


DELIMITED_HEADER_BLANK = """
SELECT o_orderpriority, count(*) AS n_rows,
       count(CASE WHEN o_orderstatus = 'F' AND o_totalprice < 100000 THEN 1 END) AS n_blank
FROM orders WHERE NOT (o_orderstatus = 'P' AND o_totalprice > 300000) GROUP BY o_orderpriority"""


def delimited_overflow(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "text AS value")
    parsed = parse_feed(docs, feed("a b c", Policy.lenient(), has_header=False))
    return parsed.selectExpr(
        "doc_id", "a", "b", "c", "coalesce(size(_overflow), 0) AS n_overflow",
        "array_join(_overflow, ',') AS overflow", "array_join(_missing, ',') AS missing",
    )


DELIMITED_OVERFLOW = """
WITH p AS (SELECT doc_id, string_split(text, ',') AS l FROM documents)
SELECT doc_id, l[1] AS a, l[2] AS b, l[3] AS c, greatest(len(l) - 3, 0) AS n_overflow,
       CASE WHEN len(l) > 3 THEN array_to_string(l[4:], ',') END AS overflow,
       CASE len(l) WHEN 1 THEN 'b,c' WHEN 2 THEN 'c' END AS missing
FROM p"""


def delimited_surplus_rejected(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "text AS value")
    parsed = parse_feed(docs, feed("a b c", has_header=False))
    return parsed.selectExpr("doc_id", "_error.type AS error_type", "_error.reason AS reason")


DELIMITED_SURPLUS_REJECTED = """
WITH p AS (SELECT doc_id, len(string_split(text, ',')) AS n FROM documents)
SELECT doc_id, CASE WHEN n > 3 THEN 'PARSE_ERROR' END AS error_type,
       CASE WHEN n > 3 THEN n || ' values for 3 fields' END AS reason
FROM p"""

SKILLS = (
    "CASE WHEN p_size <= 5 THEN ';;' WHEN p_size >= 48 THEN '' "
    "WHEN p_size > 25 THEN replace(p_name, ' ', ' ; ') || ';;' ELSE ';' || replace(p_name, ' ', ';') END"
)


def list_field(spark, sf_dir):
    contract = replace(feed("p_partkey skills", has_header=False), fields=(
        FieldRule("p_partkey"), FieldRule("skills", shape="list"),
    ))
    lines = rendered(table(spark, sf_dir, "part"), f"concat(p_partkey, ',', {SKILLS})")
    return parse_feed(lines, contract).selectExpr(
        "cast(p_partkey as bigint) AS p_partkey", "size(skills) AS n_items", "array_join(skills, '|') AS items"
    )


LIST_FIELD = f"""
WITH s AS (SELECT p_partkey, {SKILLS} AS s FROM part),
l AS (SELECT p_partkey, s, CASE WHEN s = '' THEN [''] WHEN rtrim(s, ';') = '' THEN []
             ELSE list_transform(string_split(rtrim(s, ';'), ';'), lambda x: trim(x)) END AS l FROM s)
SELECT p_partkey, len(l) AS n_items, coalesce(array_to_string(l, '|'), '') AS items FROM l"""


FIXED_ORDERS = feed(
    "o_orderkey o_custkey o_totalprice o_orderdate o_orderpriority",
    format="FIXEDWIDTH",
    columns=(
        FixedColumn("o_orderkey", 1, 12), FixedColumn("o_custkey", 14, 10), FixedColumn("o_totalprice", 25, 14),
        FixedColumn("o_orderdate", 40, 10), FixedColumn("o_orderpriority", 51, 20),
    ),
)


def fixed_width_lines(spark, sf_dir):
    full = (
        f"rpad(cast(o_orderkey as string), 13, ' ') || rpad(cast(o_custkey as string), 11, ' ') "
        f"|| lpad({money('o_totalprice')}, 14, ' ') || ' ' || {day('o_orderdate')} || ' ' || o_orderpriority"
    )
    return rendered(table(spark, sf_dir, "orders"), f"substring({full}, 1, if(o_orderstatus = 'P', 45, 100))")


def fixed_width_parse(spark, sf_dir):
    return parse_feed(fixed_width_lines(spark, sf_dir), FIXED_ORDERS).selectExpr(
        "cast(o_orderkey as bigint) AS o_orderkey", "cast(o_custkey as bigint) AS o_custkey",
        "o_totalprice", "o_orderdate", "o_orderpriority",
    )


FIXED_WIDTH_PARSE = """
SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
       substr(strftime(o_orderdate, '%Y-%m-%d'), 1, CASE WHEN o_orderstatus = 'P' THEN 6 ELSE 10 END) AS o_orderdate,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS o_orderpriority
FROM orders"""

EVENT_JSON = (
    "'{\"event_type\": \"' || event_type || '\", \"value\": ' || " + money("value")
    + " || CASE WHEN event_type = 'view' THEN '' WHEN event_type = 'signup' THEN ', \"user_id\": null' "
    "ELSE ', \"user_id\": ' || user_id END || ', \"props\": ' || props || "
    "CASE WHEN event_type = 'error' AND value < 20 THEN '' ELSE '}' END"
)


def json_lines_parse(spark, sf_dir):
    trailing = "CASE WHEN event_type = 'purchase' AND value < 20 THEN ' {}' ELSE '' END"
    lines = rendered(table(spark, sf_dir, "events"), f"{EVENT_JSON} || {trailing}", "event_id")
    contract = feed("event_type value user_id props", format="JSON")
    return parse_feed(lines, contract).selectExpr(
        "event_id", "event_type", "cast(value as double) AS amount", "user_id", "props",
        "array_join(_missing, ',') AS missing", "_error.type AS error_type",
    )


JSON_LINES_PARSE = """
WITH e AS (SELECT *, event_type IN ('error', 'purchase') AND value < 20 AS bad FROM events)
SELECT event_id, CASE WHEN NOT bad THEN event_type END AS event_type,
       CASE WHEN NOT bad THEN value END AS amount,
       CASE WHEN NOT bad AND event_type NOT IN ('view', 'signup') THEN CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN NOT bad THEN replace(props, ' ', '') END AS props,
       CASE event_type WHEN 'view' THEN 'user_id' WHEN 'signup' THEN '' END AS missing,
       CASE WHEN bad THEN 'PARSE_ERROR' END AS error_type
FROM e"""

LAYOUT = (
    "CASE event_type WHEN 'click' THEN '[' || props || ', 5, \"t\",\\n {\"k\": ' || event_id || '}]' "
    "WHEN 'view' THEN '\\n {\"k\":\\n ' || event_id || '} ' "
    "WHEN 'purchase' THEN props || '\\n\\n{\"k\": ' || event_id || '}\\n' "
    "WHEN 'signup' THEN ' \\n' ELSE '[' || props || ',' END"
)


def json_document_layouts(spark, sf_dir):
    docs = rendered(table(spark, sf_dir, "events"), LAYOUT, "event_id")
    records = parse_json_records(json_documents(docs, keep_non_objects=False), feed("k", format="JSON"))
    return records.selectExpr("event_id", "cast(k as bigint) AS k", "_error.reason AS reason")


JSON_DOCUMENT_LAYOUTS = """
SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS reason
FROM events WHERE event_type IN ('click', 'purchase')
UNION ALL SELECT event_id, event_id, NULL FROM events WHERE event_type IN ('click', 'view', 'purchase')
UNION ALL SELECT event_id, NULL, 'malformed JSON' FROM events WHERE event_type = 'error'"""


def json_non_objects_rejected(spark, sf_dir):
    docs = rendered(
        table(spark, sf_dir, "events"), "concat('[', props, ', ', event_id, ', \"t\"]')", "event_id"
    )
    records = parse_json_records(json_documents(docs), feed("k", format="JSON"))
    return records.selectExpr("event_id", "_raw AS record", "_error.type AS error_type")


JSON_NON_OBJECTS_REJECTED = """
SELECT event_id, replace(props, ' ', '') AS record, CAST(NULL AS VARCHAR) AS error_type FROM events
UNION ALL SELECT event_id, CAST(event_id AS VARCHAR), 'PARSE_ERROR' FROM events
UNION ALL SELECT event_id, 't', 'PARSE_ERROR' FROM events"""


def xml_fragment_parse(spark, sf_dir):
    docs = rendered(
        table(spark, sf_dir, "customer"),
        "concat('<?xml version=\"1.0\"?><cs> <c><key>', c_custkey, '</key><name>', c_name, ' &amp; Co</name><seg>', "
        "c_mktsegment, '</seg>', CASE WHEN c_acctbal < 0 THEN '<note/>' WHEN c_acctbal < 5000 "
        "THEN concat('<note> ', " + money("c_acctbal") + ", '</note>') ELSE '' END, "
        "CASE WHEN c_mktsegment = 'BUILDING' THEN '<open>' ELSE '' END, '</c> <c x=\"1\"><key>0</key></c></cs>')",
        "c_custkey",
    )
    contract = feed("key name seg note", format="XML", row_tag="c")
    parsed = parse_xml_fragments(row_fragments(chunks_of_documents(docs, "c"), "c"), contract)
    return parsed.selectExpr(
        "c_custkey", "cast(key as bigint) AS key", "name", "seg", "note",
        "array_join(_missing, ',') AS missing", "_error.type AS error_type",
    )


XML_FRAGMENT_PARSE = """
WITH c AS (SELECT *, c_mktsegment = 'BUILDING' AS bad FROM customer)
SELECT c_custkey, CASE WHEN NOT bad THEN c_custkey END AS key,
       CASE WHEN NOT bad THEN c_name || ' & Co' END AS name,
       CASE WHEN NOT bad THEN c_mktsegment END AS seg,
       CASE WHEN bad THEN NULL WHEN c_acctbal < 0 THEN ''
            WHEN c_acctbal < 5000 THEN ' ' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS note,
       CASE WHEN NOT bad AND c_acctbal >= 5000 THEN 'note' END AS missing,
       CASE WHEN bad THEN 'PARSE_ERROR' END AS error_type
FROM c"""


def markup_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "pages").selectExpr("page_id", "html AS value")
    items = row_fragments(chunks_of_documents(docs, "li"), "li")
    return items.selectExpr("page_id", "length(value) AS n").groupBy("page_id").agg(
        {"*": "count", "n": "sum"}
    ).selectExpr("page_id", "`count(1)` AS n_rows", "`sum(n)` AS n_chars")


MARKUP_ROWS = """
WITH f AS (SELECT page_id, regexp_extract_all(html, '(?s)<li>.*?</li>') AS l FROM pages)
SELECT page_id, len(l) AS n_rows, CAST(list_sum(list_transform(l, lambda x: length(x))) AS BIGINT) AS n_chars
FROM f WHERE len(l) > 0"""

PIPED = (
    "concat_ws('|', CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE cast(o_orderkey as {text}) END, "
    "CASE WHEN o_orderpriority = '5-LOW' THEN 'null' WHEN o_orderpriority = '2-HIGH' THEN 'NULL' ELSE '' END, "
    "CASE WHEN o_totalprice > 300000 THEN '' WHEN o_totalprice < 100000 THEN 'null' ELSE 'x' END, "
    "CASE WHEN o_orderstatus = 'F' THEN 'NULL' WHEN o_orderpriority = '1-URGENT' THEN 'null' ELSE o_orderstatus END)"
)


def null_token_cleanse(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", f"{PIPED.format(text='string')} AS line")
    docs = table(spark, sf_dir, "documents").selectExpr("-1 - doc_id AS id", "text AS line")
    return orders.unionByName(docs).selectExpr("id", f"{replace_null_tokens('line')} AS cleansed")


def _nested_replace(c: str) -> str:
    for pattern, blank in (
        (r"\|null\|", "| |"), (r"\|null$", "| "), (r"^null\|", " |"),
        (r"\|NULL\|", "| |"), (r"\|NULL$", "| "), (r"\|\|", "| |"),
    ):
        c = f"regexp_replace({c}, '{pattern}', '{blank}', 'g')"
    return c


NULL_TOKEN_CLEANSE = f"""
SELECT o_orderkey AS id, {_nested_replace(PIPED.format(text='varchar'))} AS cleansed FROM orders
UNION ALL SELECT -1 - doc_id, {_nested_replace('text')} FROM documents"""


def null_word_cleanse(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderstatus WHEN 'P' THEN 'null' WHEN 'F' THEN 'NULL' ELSE 'Null' END AS a",
        "CASE WHEN o_totalprice > 300000 THEN concat('x|null|', o_orderkey, '||y') ELSE 'a|null' END AS b",
    )
    return cleanse_nulls(rows, ["a", "b"], whole_words=True)


NULL_WORD_CLEANSE = """
SELECT o_orderkey, CASE WHEN o_orderstatus IN ('P', 'F') THEN ' ' ELSE 'Null' END AS a,
       CASE WHEN o_totalprice > 300000 THEN 'x| |' || o_orderkey || '| |y' ELSE 'a|null' END AS b
FROM orders"""


def json_escape(spark, sf_dir):
    return table(spark, sf_dir, "documents").selectExpr("doc_id", f"{json_quote('text')} AS quoted")


def file_base_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").selectExpr("page_id", f"{base_name('url')} AS file_name")


CATALOG = {
    "delimited_parse": Query(delimited_parse, DELIMITED_PARSE),
    "delimited_header_blank": Query(delimited_header_blank, DELIMITED_HEADER_BLANK),
    "delimited_overflow": Query(delimited_overflow, DELIMITED_OVERFLOW),
    "delimited_surplus_rejected": Query(delimited_surplus_rejected, DELIMITED_SURPLUS_REJECTED),
    "list_field": Query(list_field, LIST_FIELD),
    "fixed_width_parse": Query(fixed_width_parse, FIXED_WIDTH_PARSE),
    "json_lines_parse": Query(json_lines_parse, JSON_LINES_PARSE),
    "json_document_layouts": Query(json_document_layouts, JSON_DOCUMENT_LAYOUTS),
    "json_non_objects_rejected": Query(json_non_objects_rejected, JSON_NON_OBJECTS_REJECTED),
    "xml_fragment_parse": Query(xml_fragment_parse, XML_FRAGMENT_PARSE),
    "markup_rows": Query(markup_rows, MARKUP_ROWS),
    "null_token_cleanse": Query(null_token_cleanse, NULL_TOKEN_CLEANSE),
    "null_word_cleanse": Query(null_word_cleanse, NULL_WORD_CLEANSE),
    "json_escape": Query(json_escape, "SELECT doc_id, CAST(to_json(text) AS VARCHAR) AS quoted FROM documents"),
    "file_base_name": Query(
        file_base_name, "SELECT page_id, string_split(url, '/')[-1] AS file_name FROM pages"
    ),
}
