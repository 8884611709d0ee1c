"""Encryption and decryption. Ciphertext differs on every run, so the queries
return what does not: the decrypted text, and the shape of the ciphertext."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.contract import Contract, FieldRule, Policy
from landfall.functions.crypto import KEY, decrypt_text, encrypt_text, try_decrypt_text, with_key
from landfall.operators.protect import decrypt_columns, encrypt_columns
from landfall.plans.catalog.base import Query, fresh_key, money, table


def encrypt_roundtrip(spark, sf_dir):
    key = fresh_key(spark)
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS c_name",
        f"{money('c_acctbal')} AS c_acctbal",
    )
    secret = Contract((FieldRule("c_name", encrypt="value"), FieldRule("c_acctbal", encrypt="value")))
    return decrypt_columns(encrypt_columns(rows, secret, key), ["c_name", "c_acctbal"], key)


ENCRYPT_ROUNDTRIP = """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' OR c_acctbal < 0 THEN ' ' ELSE c_name END AS c_name,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal
FROM customer"""


def encrypt_long_texts(spark, sf_dir):
    key = fresh_key(spark)
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id", "text")
    secret = Contract((FieldRule("text", encrypt="value"),))
    return decrypt_columns(encrypt_columns(rows, secret, key), ["text"], key)


def encrypt_member(spark, sf_dir):
    key = fresh_key(spark)
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "named_struct('name', c_mktsegment, 'phone', CASE WHEN c_acctbal < 0 THEN '' ELSE c_name END, "
        "'n', c_nationkey) AS contact",
    )
    sealed = encrypt_columns(rows, Contract((FieldRule("contact", encrypt="value"),), policy=Policy.lenient()), key)
    return with_key(sealed, key, lambda df: df.selectExpr(
        "c_custkey", "contact.name AS name", "contact.n AS n", "contact.phone LIKE 'Customer%' AS readable",
        f"{decrypt_text('contact.phone')} AS phone", KEY,
    ))


ENCRYPT_MEMBER = """
SELECT c_custkey, c_mktsegment AS name, c_nationkey AS n, false AS readable,
       CASE WHEN c_acctbal < 0 THEN ' ' ELSE c_name END AS phone
FROM customer"""


def encrypt_member_of_list(spark, sf_dir):
    key = fresh_key(spark)
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "array(named_struct('phone', cast(o_custkey as string), 'rank', 1), "
        "named_struct('phone', CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END, 'rank', 2)) AS contacts",
    )
    sealed = encrypt_columns(rows, Contract((FieldRule("contacts", encrypt="value"),)), key)
    opened = f"transform(contacts, x -> concat({decrypt_text('x.phone')}, '/', x.rank))"
    return with_key(sealed, key, lambda df: df.selectExpr(
        "o_orderkey", f"array_join({opened}, ';') AS contacts",
        "exists(contacts, x -> x.phone = cast(o_orderkey as string)) AS readable", KEY,
    ))


ENCRYPT_MEMBER_OF_LIST = """
SELECT o_orderkey, o_custkey || '/1;' || CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE o_orderpriority END || '/2'
       AS contacts, false AS readable
FROM orders"""

CONTACT = (
    "CASE event_type WHEN 'click' THEN concat('{\"phone\":\"', event_id, '\",\"k\":', user_id, '}') "
    "WHEN 'view' THEN concat('[{\"phone\":\"', event_id, '\"},\"s\"]') "
    "WHEN 'signup' THEN concat('\"', event_id, '\"') WHEN 'purchase' THEN '{\"k\":1}' ELSE 'null' END"
)


def encrypt_json_value(spark, sf_dir):
    """One field that is an object, a list, a text or null from row to row, read leniently: the phone alone is sealed."""
    key = fresh_key(spark)
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "event_type", f"parse_json({CONTACT}) AS contact")
    sealed = encrypt_columns(rows, Contract((FieldRule("contact", encrypt="value"),), policy=Policy.lenient()), key)
    cipher = (
        "CASE event_type WHEN 'click' THEN get_json_object(contact, '$.phone') "
        "WHEN 'view' THEN get_json_object(contact, '$[0].phone') WHEN 'signup' THEN contact END"
    )
    return with_key(sealed.withColumn("_c", F.expr(cipher)), key, lambda df: df.selectExpr(
        "event_id", f"CASE WHEN _c IS NOT NULL THEN {decrypt_text('_c')} END AS phone",
        "CASE WHEN event_type <> 'signup' THEN regexp_replace(contact, '\"phone\":\"[^\"]*\"', '\"phone\":0') END AS rest",
        "_c = cast(event_id as string) AS readable", KEY,
    ))


ENCRYPT_JSON_VALUE = """
SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'signup') THEN CAST(event_id AS VARCHAR) END AS phone,
       CASE event_type WHEN 'click' THEN '{"k":' || user_id || ',"phone":0}' WHEN 'view' THEN '[{"phone":0},"s"]'
            WHEN 'purchase' THEN '{"k":1}' END AS rest,
       CASE WHEN event_type IN ('click', 'view', 'signup') THEN false END AS readable
FROM events"""


def encrypt_json_text(spark, sf_dir):
    """Text columns that hold JSON, some of it cut off."""
    key = fresh_key(spark)
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "concat('{\"name\":\"', c_mktsegment, '\",\"phone\":\"', c_name, '\"', "
        "CASE WHEN c_acctbal < 0 THEN '' ELSE '}' END) AS contact",
    )
    sealed = encrypt_columns(rows, Contract((FieldRule("contact", encrypt="phone"),)), key)
    return with_key(sealed, key, lambda df: df.selectExpr(
        "c_custkey", "get_json_object(contact, '$.name') AS name",
        "contact LIKE '%Customer%' AS readable",
        f"{try_decrypt_text('coalesce(get_json_object(contact, "$.phone"), contact)')} AS opened", KEY,
    ))


ENCRYPT_JSON_TEXT = """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS name, false AS readable,
       CASE WHEN c_acctbal >= 0 THEN c_name
            ELSE '{"name":"' || c_mktsegment || '","phone":"' || c_name || '"' END AS opened
FROM customer"""


def ciphertext_shape(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "CASE WHEN lang = 'de' THEN '' ELSE text END AS a", "CASE WHEN lang = 'de' THEN '' ELSE text END AS b",
    )
    return with_key(rows, fresh_key(spark), lambda df: df.selectExpr(
        "doc_id", f"{encrypt_text('a')} AS a", f"{encrypt_text('b')} AS b", "octet_length(a) AS n", KEY,
    ).selectExpr("doc_id", "n", "length(a) AS n_cipher", "rlike(a, '^[A-Za-z0-9+/]*={0,2}$') AS is_base64", KEY))


CIPHERTEXT_SHAPE = """
WITH d AS (SELECT doc_id, CASE WHEN lang = 'de' THEN 0 ELSE strlen(text) END AS n FROM documents)
SELECT doc_id, n, CASE WHEN n = 0 THEN 0 ELSE 4 * CAST(floor((n + 28 + 2) / 3) AS BIGINT) END AS n_cipher,
       true AS is_base64
FROM d"""


def decrypt_bad_input(spark, sf_dir):
    key = fresh_key(spark)
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name", "c_mktsegment")
    sealed = with_key(rows, key, lambda df: df.selectExpr(
        "c_custkey", "c_mktsegment", f"{encrypt_text('c_name')} AS c", KEY,
    ))
    damaged = sealed.selectExpr(
        "c_custkey",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'not base64!' WHEN 'MACHINERY' THEN '' "
        "WHEN 'FURNITURE' THEN concat(substring(c, 1, length(c) - 4), 'AAA=') "
        "WHEN 'HOUSEHOLD' THEN NULL ELSE c END AS c",
    )
    return decrypt_columns(damaged, ["c"], key, damaged_to_null=True).withColumnRenamed("c", "c_name")


DECRYPT_BAD_INPUT = """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN NULL
       WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN ' ' ELSE c_name END AS c_name
FROM customer"""

CATALOG = {
    "encrypt_roundtrip": Query(encrypt_roundtrip, ENCRYPT_ROUNDTRIP),
    "encrypt_long_texts": Query(encrypt_long_texts, "SELECT doc_id, text FROM documents"),
    "encrypt_member": Query(encrypt_member, ENCRYPT_MEMBER),
    "encrypt_member_of_list": Query(encrypt_member_of_list, ENCRYPT_MEMBER_OF_LIST),
    "encrypt_json_value": Query(encrypt_json_value, ENCRYPT_JSON_VALUE),
    "encrypt_json_text": Query(encrypt_json_text, ENCRYPT_JSON_TEXT),
    "ciphertext_shape": Query(ciphertext_shape, CIPHERTEXT_SHAPE),
    "decrypt_bad_input": Query(decrypt_bad_input, DECRYPT_BAD_INPUT),
}
