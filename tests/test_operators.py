"""Rules, protection, audit, reconciliation, sinks and splitting."""

import base64
import os
import random
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import boats
from landfall import Policy, parse_contract
from landfall.__main__ import arguments
from landfall.contract import Contract, FieldRule
from landfall.functions.crypto import KeyProblem, encrypt_text, key_column, with_key
from landfall.functions.errors import NO_ERROR, humanize
from landfall.functions.text import (
    NULL_TOKENS, base_name, is_blank, json_quote, parse_instant, preview, replace_null_tokens, split_list, strip,
    utf16_length,
)
from landfall.operators import audit
from landfall.operators.protect import decrypt_columns, encrypt_columns
from landfall.operators.quality import validate
from landfall.operators.reconcile import reconcile
from landfall.operators.routing import error_rows, read_envelopes, valid_rows
from landfall.operators.sinks import JdbcTable, write_error_text, write_table
from landfall.operators.splitting import needs_split, part_count, split_files, split_plan
from landfall.plans.prepare import prepare
from landfall.plans.workspace import shared_dir
from landfall.sources import parse_feed, read_feed


def values(spark, texts, *exprs):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [tuple(r) for r in df.orderBy("i").selectExpr(*exprs).collect()]


class TestText:
    def test_against_python(self, spark):
        rng = random.Random(7)
        alphabet = ["|", "null", "NULL", " ", "a", "\t", "\n", ";", "é", "\x01", "𝒳", "'", '"', "\\"]
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 9))) for _ in range(400)]
        blanks = "".join(map(chr, range(33)))
        import json
        import re

        def tokens(t):
            for pattern, blank in NULL_TOKENS:
                t = re.sub(pattern.replace("$", r"(?=\n?\Z)"), blank, t)
            return t

        def items(t):
            if t == "":
                return [""]
            kept = t.rstrip(";")
            return [x.strip(blanks) for x in kept.split(";")] if kept else []

        got = values(
            spark, texts, "c", strip("c"), is_blank("c"), replace_null_tokens("c"), split_list("c"), utf16_length("c"),
            json_quote("c"),
        )
        for t, s, b, n, l, u, q in got:
            assert s == t.strip(blanks)
            assert b == (t.strip(blanks) == "")
            assert n == tokens(t)
            assert l == items(t)
            assert u == len(t.encode("utf-16-be")) // 2
            assert json.loads(q) == t

    def test_blanks_end_at_u0020(self, spark):
        texts = [None, "", " ", "\x00\x1f ", " !", "!", "a", "\x7f", "\x80", "\u00a0", "é", "𝒳"]
        wanted = [None, True, True, True, *[False] * 8]
        assert [b for (b,) in values(spark, texts, is_blank("c"))] == wanted

    def test_good_rows_meet_no_lambda(self, spark):
        """What is interpreted stands behind a check that is compiled, and the outcome is the lambda's."""
        fields = [FieldRule("a", required=True, max_length=2), FieldRule("b", required=True, min_length=1, max_length=3), FieldRule("c", required=True)]
        cells = [None, "", " ", "!", "é", "𝒳𝒳", "abcd"]
        rows = [(a, b, c) for a in cells for b in cells for c in ("", "x")]
        df = spark.createDataFrame(rows, "a string, b string, c string").selectExpr("*", "cast(NULL as array<string>) AS _missing", f"{NO_ERROR} AS _error")
        checked = validate(df, Contract(tuple(fields)))
        plan = checked._jdf.queryExecution().optimizedPlan().toString()
        first, second = plan.split("exists(", 2)[:2]
        assert "least(!" in first and "octet_length(b" in second.split("filter(")[-1]

        def wanted(row):
            texts = [None if v is None else v.strip(" ") for v in row]
            if not any(texts):
                return "", ""
            for name, v in zip("abc", texts, strict=True):
                if not v:
                    return name, "null" if v is None else "empty"
            for name, v, low, high in (("a", row[0], 0, 2), ("b", row[1], 1, 3)):
                n = len(v.encode("utf-16-be")) // 2
                if not low <= n <= high:
                    return name, f"length {n} outside {low}..{high}"
            return None, None

        for r in checked.collect():
            got = (r._error.field, r._error.reason) if r._error else (None, None)
            assert got == wanted((r.a, r.b, r.c)), r

    def test_rest(self, spark):
        assert values(spark, ["x" * 200, "x" * 201], f"length({preview('c')})") == [(200,), (203,)]
        assert values(spark, ["/a/b.csv", "b.csv"], base_name("c")) == [("b.csv",), ("b.csv",)]
        got = values(spark, ["2026-01-02T03:04:05.678Z", " ", "", "no"], f"unix_millis({parse_instant('c')})")
        assert got == [(1767323045678,), (None,), (None,), (None,)]
        assert values(spark, [None], replace_null_tokens("c"), json_quote("c")) == [("", '""')]

    def test_messages(self, spark):
        cases = [
            ("BLANK_ROW", "", "", "Row is empty - all required fields are blank"),
            ("PARSE_ERROR", "", "bad", "Could not parse the row: bad"),
            ("VALIDATION_ERROR", "", "odd", "Validation failed: odd"),
            ("VALIDATION_ERROR", "f", "empty", "Required field 'f' is empty - cannot be blank"),
            ("VALIDATION_ERROR", "f", "null", "Required field 'f' is null"),
            ("VALIDATION_ERROR", "f", "json_parse_failed:x", "Row is not valid JSON: x"),
            ("VALIDATION_ERROR", "f", "too odd", "Field 'f' validation failed: too odd"),
        ]
        df = spark.createDataFrame(cases, "k string, f string, r string, m string")
        assert df.filter(f"m <> {humanize('k', 'f', 'r')}").count() == 0

    def test_envelopes(self, spark):
        lines = ["PARSE_ERROR|csv|why|a|b", "VALIDATION_ERROR|w|f|null|{}", "ERROR|m|d", "BLANK|", "PARSE_ERROR|x", "ok"]
        df = spark.createDataFrame([(x,) for x in lines], "line string")
        assert [tuple(r.e) for r in read_envelopes(df, "line", "e").select("e").collect()] == [
            ("PARSE_ERROR", "csv", "", "Could not parse the row: why", "a"),
            ("VALIDATION_ERROR", "w", "f", "Required field 'f' is null", "{}"),
            ("ERROR", "", "", "m", "d"),
            ("BLANK_ROW", "", "", "Row is empty - all required fields are blank", ""),
            ("UNKNOWN", "", "", "PARSE_ERROR|x", ""), ("UNKNOWN", "", "", "ok", ""),
        ]


class TestRules:
    def test_first_problem_wins(self, lines):
        c = Contract((
            FieldRule("a", required=True, max_length=3), FieldRule("b", required=True, type="int"),
            FieldRule("d", allowed=("x", "y"), width=2, pattern="^[a-z]*$", not_null=True),
        ), has_header=False)
        df = validate(parse_feed(lines("1,2,x", " , ,", ",2,x", "1", "12345,z,q", "1,z,q", "1,2,zz", "1,2,Y!", "1,2"), c), c)
        assert [tuple(r) for r in df.select("_error.field", "_error.reason").collect()] == [
            (None, None), ("", ""), ("a", "empty"), ("b", "missing"), ("a", "length 5 outside 0..3"), ("b", "not a int"),
            ("d", "not one of x/y"), ("d", "not one of x/y"), ("d", "null in a NOT NULL column"),
        ]
        assert valid_rows(df).count() + error_rows(df).count() == 9

    def test_many_rules_stay_small_and_are_checked_once(self, spark, lines):
        n = 60
        fields = tuple(FieldRule(f"f{i}", required=True, max_length=9, type="int", pattern="^[0-9]+$") for i in range(n))
        c = Contract(fields, has_header=False)
        good = ",".join(str(i) for i in range(n))
        df = validate(parse_feed(lines(good, good.replace("59", "x59")), c), c)
        assert [r.e.field if r.e else None for r in df.selectExpr("_error AS e").collect()] == [None, "f59"]
        plan = df.filter("_error IS NULL")._jdf.queryExecution().executedPlan().treeString()
        assert plan.count("split(") == 1

    def test_length_rule(self, spark):
        texts = spark.createDataFrame([(i, t) for i, t in enumerate([None, "", "a", "abc", "abcd", "𝒳𝒳"])], "id int, c string")
        rows = texts.selectExpr("*", "cast(NULL as array<string>) AS _missing", f"{NO_ERROR} AS _error")
        for rule, want in (
            (FieldRule("c", required=True, min_length=2, max_length=3),
             ["null", "empty", "length 1 outside 2..3", None, "length 4 outside 2..3", "length 4 outside 2..3"]),
            (FieldRule("c", min_length=0), ["length of null outside 0..", None, None, None, None, None]),
        ):
            found = validate(rows, Contract((FieldRule("id", required=True), rule))).orderBy("id").select("_error.reason")
            assert [r[0] for r in found.collect()] == want

    def test_no_required_field(self, lines):
        c = Contract((FieldRule("a"), FieldRule("b")), has_header=False)
        for policy, want in ((Policy(), ["BLANK_ROW", None]), (Policy.lenient(), ["BLANK_ROW", "BLANK_ROW"])):
            d = c.with_policy(policy)
            df = validate(parse_feed(lines(" ,", "1,"), d), d)
            assert [r[0] for r in df.select("_error.type").collect()] == want


class TestProtection:
    def test_key_is_checked(self, spark):
        for bad in (None, " ", "***", base64.b64encode(b"short").decode()):
            with pytest.raises(KeyProblem):
                key_column(spark, bad)
        with pytest.raises(KeyProblem):
            encrypt_columns(spark.range(1), Contract((FieldRule("id", encrypt="value"),)), None)

    @pytest.mark.parametrize("size", [16, 24, 32])
    def test_round_trip_and_fresh_ivs(self, spark, size):
        key = key_column(spark, base64.b64encode(os.urandom(size)).decode())
        df = spark.createDataFrame([(t,) for t in ["same", "same", " ", "", None, "ü" * 300]], "t string")
        sealed = encrypt_columns(df, Contract((FieldRule("t", encrypt="value"),)), key)
        cipher = [r.t for r in sealed.collect()]
        assert cipher[3:5] == ["", None] and len(set(cipher)) == 6 and "\n" not in "".join(c or "" for c in cipher)
        opened = [r.t for r in decrypt_columns(sealed, ["t"], key).collect()]
        assert opened == ["same", "same", " ", " ", " ", "ü" * 300]

    def test_layout_is_iv_ciphertext_tag(self, spark):
        raw = os.urandom(32)
        df = spark.createDataFrame([("secret value",)], "t string")
        key = key_column(spark, base64.b64encode(raw).decode())
        cipher = base64.b64decode(with_key(df, key, lambda d: d.selectExpr(f"{encrypt_text('t')} AS t", "_aes_key")).first().t)
        jvm = spark._jvm
        aes = jvm.javax.crypto.Cipher.getInstance("AES/GCM/NoPadding")
        aes.init(2, jvm.javax.crypto.spec.SecretKeySpec(raw, "AES"), jvm.javax.crypto.spec.GCMParameterSpec(128, cipher[:12]))
        assert bytes(aes.doFinal(cipher[12:])).decode() == "secret value"

    def test_key_is_in_no_plan(self, spark, aes_key):
        df = spark.createDataFrame([("x",)], "t string")
        sealed = encrypt_columns(df, Contract((FieldRule("t", encrypt="value"),)), key_column(spark, aes_key))
        text = sealed._jdf.queryExecution().toString().lower()
        assert aes_key.lower() not in text and base64.b64decode(aes_key).hex() not in text

    def test_damage(self, spark, aes_key):
        key, other = key_column(spark, aes_key), key_column(spark, base64.b64encode(os.urandom(32)).decode())
        df = spark.createDataFrame([("x",)], "t string")
        sealed = encrypt_columns(df, Contract((FieldRule("t", encrypt="value"),)), key)
        assert decrypt_columns(sealed, ["t"], other, damaged_to_null=True).first().t is None
        with pytest.raises(Exception):
            decrypt_columns(sealed, ["t"], other).collect()

    def test_nothing_to_encrypt(self, spark):
        df = spark.range(1)
        assert encrypt_columns(df, Contract((FieldRule("id"),)), None) is df


def fold(events):
    """The row-by-row meaning of the log: one table row, updated in order."""
    row = None
    for e in sorted(events, key=lambda e: (e["attempt"], e["seq"])):
        if e["kind"] == audit.STARTED:
            row = row or {"expected": None, "actual": None, "reason": None, "created": e["event_time"],
                          "file": e["file_path"]}
            row |= {"status": "RUNNING", "updated": e["event_time"]}
        elif e["kind"] == audit.ABORTED:
            if row["status"] != "PASSED":
                row |= {"status": "FAILED", "reason": e["failure_reason"], "updated": e["event_time"]}
        elif e["kind"] == audit.COUNTED:
            key = "expected" if e.get("expected_count") is not None else "actual"
            row |= {key: e[f"{key}_count"], "updated": e["event_time"]}
        else:
            row |= {"status": e["status"], "updated": e["event_time"]}
            if e["status"] == "FAILED":
                row["reason"] = e["failure_reason"]
    return row


class TestAudit:
    def test_fold_equals_row_updates(self, spark):
        rng = random.Random(3)
        base = datetime(2026, 1, 1)
        log, want = [], {}
        for run in range(60):
            mine = []
            for attempt in range(rng.randint(1, 4)):
                at = base + timedelta(hours=attempt, seconds=run)

                def event(seq, kind, **kw):
                    mine.append({"execution_id": f"r{run}", "attempt": at, "seq": seq, "kind": kind,
                                 "event_time": at + timedelta(seconds=seq), **kw})

                event(0, audit.STARTED, status="RUNNING", file_path=f"/in/{run}/{attempt}")
                end = rng.choice(["hang", "abort", "pass", "fail", "pass+abort", "fail+abort"])
                if end != "hang" and rng.random() < 0.7:
                    event(1, audit.COUNTED, expected_count=rng.randint(1, 9))
                if end not in ("hang", "abort"):
                    event(2, audit.COUNTED, actual_count=rng.randint(1, 9))
                    ok = end.startswith("pass")
                    event(3, audit.FINISHED, status="PASSED" if ok else "FAILED",
                          failure_reason=None if ok else f"mismatch {attempt}")
                if "abort" in end:
                    event(4, audit.ABORTED, failure_reason=f"error {attempt}")
            log += mine
            want[f"r{run}"] = fold(mine)
        rng.shuffle(log)
        states = audit.run_states(spark.createDataFrame(log, audit.EVENT_SCHEMA)).collect()
        got = {
            r.execution_id: {
                "expected": r.expected_count, "actual": r.actual_count, "reason": r.failure_reason,
                "created": r.creation_timestamp, "file": r.file_path, "status": r.status, "updated": r.updated_timestamp,
            }
            for r in states
        }
        assert got == want

    def test_reconcile(self, spark):
        expected = spark.createDataFrame([("a", 3), ("b", 3), ("c", None), ("e", 2)], "execution_id string, expected_count long")
        actual = spark.createDataFrame([("a", 3), ("b", 1), ("c", 9), ("d", 4)], "execution_id string, actual_count long")
        got = {r[0]: tuple(r)[1:] for r in reconcile(expected, actual).collect()}
        text = "Record count mismatch! Expected: {}, Actual: {}, Difference: {}"
        assert got == {
            "a": (3, 3, 0, "PASSED", None), "b": (3, 1, -2, "FAILED", text.format(3, 1, -2)),
            "c": (None, 9, None, "PASSED", None), "d": (None, 4, None, "PASSED", None),
            "e": (2, 0, -2, "FAILED", text.format(2, 0, -2)),
        }


class TestSinks:
    def test_table_keeps_other_runs(self, spark, tmp_path):
        path = str(tmp_path / "t")
        one = spark.createDataFrame([("a", 1), ("b", 1)], "execution_id string, v int")
        write_table(one, path, ["execution_id"])
        write_table(spark.createDataFrame([("b", 2), ("b", 3)], one.schema), path, ["execution_id"])
        assert sorted((r.execution_id, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 2), ("b", 3)]

    def test_error_report_file(self, spark, tmp_path):
        df = spark.createDataFrame(
            [("VALIDATION_ERROR", "warehouse", "f", "M", "x" * 300), ("BLANK_ROW", "", "", "E", "")],
            "error_type string, stage string, field string, message string, data string",
        ).withColumn("ingestion_timestamp", F.expr("timestamp'2026-01-02T03:04:05Z'"))
        write_error_text(df.coalesce(1), str(tmp_path / "e"))
        text = "".join(p.read_text() for p in (tmp_path / "e").glob("part-*"))
        assert text == (
            "Timestamp     : 2026-01-02T03:04:05.000Z\nError Type    : VALIDATION_ERROR\nStage         : warehouse\n"
            f"Field         : f\nMessage       : M\nData          : {'x' * 200}...\n\n"
            "Timestamp     : 2026-01-02T03:04:05.000Z\nError Type    : BLANK_ROW\nMessage       : E\n\n"
        )

    def test_jdbc_options(self):
        target = JdbcTable("jdbc:x:y", "stg", "u", "hidden", "d.D", 100, 4)
        o = target.options()
        assert (o["dbtable"], o["batchsize"], o["numPartitions"], o["driver"]) == ("stg", "100", "4", "d.D")
        assert "hidden" not in repr(target)

    def test_shared_dir_follows_the_session(self, spark):
        root = spark.conf.get("spark.checkpoint.dir")
        a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
        assert a.startswith(root) and a != b

    def test_shared_dir_without_the_setting(self):
        def session(master):
            return SimpleNamespace(
                conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master)
            )

        assert os.path.isdir(shared_dir(session("local[2]"), "x").split("/landfall/")[0])
        with pytest.raises(RuntimeError):
            shared_dir(session("yarn"), "x")


SPLITS = {
    "boats.csv": (boats.csv_file(), boats.descriptor("CSV")),
    "boats.json": (boats.json_file(), boats.descriptor("JSON", is_json_array=True)),
    "boats.xml": (boats.xml_file(), boats.descriptor("XML", row_tag="boat")),
    "boats.txt": (boats.fixed_file(), boats.fixed_descriptor()),
}


class TestSplitting:
    def test_sizes(self, spark):
        kb = 1024
        sizes = [None, 0, 5120 * kb, 5121 * kb - 1, 5121 * kb, kb, kb + 1, 10 * kb * kb]
        df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i int, n long").orderBy("i")
        got = [tuple(r) for r in df.selectExpr(needs_split("n"), part_count("n")).collect()]
        want = [(s is not None and s // kb > 5120, max(1, int((s or 0) / kb / kb + 0.999))) for s in sizes]
        assert got == want

    @pytest.mark.parametrize("name", SPLITS)
    def test_parts_parse_as_the_source_does(self, spark, tmp_path, name):
        text, descriptor = SPLITS[name]
        (tmp_path / name).write_text(text)
        c = parse_contract(descriptor)
        out = str(tmp_path / "parts")
        manifest = split_files(spark, str(tmp_path / name), c, out, target_kb=1)
        before = read_feed(spark, str(tmp_path / name), c)
        after_contract = parse_contract(descriptor.replace('"is_json_array": true', '"is_json_array": false'))
        after = read_feed(spark, out, after_contract)

        def content(df):
            return sorted(str(r) for r in df.select(*[F.col(f).cast("string") for f in c.names], "_error").collect())

        assert content(before) == content(after)
        assert sum(r.rows for r in manifest.collect()) == before.count() + (name == "boats.txt")

    def test_no_shuffle_and_planned_number_of_parts(self, spark, tmp_path):
        lines = "\n".join(f"{i},{'x' * 80}" for i in range(5000))
        (tmp_path / "big.csv").write_text("id,text\n" + lines)
        c = Contract((FieldRule("id"), FieldRule("text")))
        planned = split_plan(spark, str(tmp_path / "big.csv"), target_kb=64).first().parts
        manifest = split_files(spark, str(tmp_path / "big.csv"), c, str(tmp_path / "p"), target_kb=64).collect()
        assert len(manifest) == planned
        assert sum(r.rows for r in manifest) == 5000
        assert all(r.bytes <= 66 * 1024 for r in manifest)
        heads = [p.read_text().split("\n", 1)[0] for p in (tmp_path / "p").glob("part-*")]
        assert set(heads) == {"id,text"} and len(heads) == planned

    def test_prepare_splits_only_what_is_large(self, spark, tmp_path):
        c = parse_contract(boats.descriptor("JSON", is_json_array=True))
        (tmp_path / "s.json").write_text(boats.json_file())
        path, out = str(tmp_path / "s.json"), str(tmp_path / "p")
        assert prepare(spark, path, c, out) == ([path], c)
        assert prepare(spark, str(tmp_path / "gone"), c, out, threshold_kb=0) == ([str(tmp_path / "gone")], c)
        paths, lines = prepare(spark, path, c, out, threshold_kb=1, target_kb=1)
        assert paths == [out] and not lines.is_json_array
        assert read_feed(spark, paths, lines).count() == 3
        # The array contract itself also reads the parts: what they hold is seen in the text.
        assert read_feed(spark, paths, c).count() == 3

    def test_xml_parts_are_documents(self, spark, tmp_path):
        import xml.etree.ElementTree as ET

        (tmp_path / "s.xml").write_text(boats.xml_file())
        c = parse_contract(boats.descriptor("XML", row_tag="boat"))
        split_files(spark, str(tmp_path / "s.xml"), c, str(tmp_path / "p"), target_kb=1)
        roots = [ET.parse(p).getroot() for p in (tmp_path / "p").glob("part-*")]
        assert {r.tag for r in roots} == {"boats"} and sum(len(r) for r in roots) == 3


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_characters="\r\n", blacklist_categories=("Cs",)), max_size=30),
                min_size=1, max_size=8))
def test_rows_in_are_rows_out(texts):
    """Whatever the lines hold, each one that is not a header ends up good or bad."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    c = Contract((FieldRule("a", required=True), FieldRule("b", max_length=5)))
    df = validate(parse_feed(spark.createDataFrame([(t,) for t in texts], "value string"), c), c)
    want = sum(not t.startswith("a,") for t in texts)
    assert valid_rows(df).count() + error_rows(df).count() == want


def test_command_line():
    a = arguments(["intake", "x", "y", "--contract", "c", "--location", "l", "--audit", "u", "--lenient"])
    assert a.paths == ["x", "y"] and a.lenient and a.execution_id is None
    assert arguments(["split", "x", "--contract", "c", "--out", "o"]).target_kb == 1024


def test_cleanse_reaches_escaped_pipes(spark):
    """The tokens of a value go, however its record spells the pipes."""
    from landfall.operators.enrich import cleanse_nulls
    from landfall.sources.json_records import parse_json_records

    plain, escaped = '{"a": "x|null|y"}', '{"a": "x\\u007Cnull\\u007cy"}'
    rows = spark.createDataFrame([(plain,), (escaped,)], "value string")
    contract = Contract((FieldRule("a"),), format="JSON")
    cleaned = {r.a for r in cleanse_nulls(parse_json_records(rows, contract), ["a"]).collect()}
    assert len(cleaned) == 1 and "null" not in cleaned.pop()
