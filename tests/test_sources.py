"""Parsers, on rows and files small enough to check by eye."""

import json
from dataclasses import replace

import pytest

from landfall import Policy, parse_contract
from landfall.contract import Contract, ContractError, FieldRule, FixedColumn
from landfall.sources import feed as feeds, parse_feed, read_feed
from landfall.sources.control import ControlFileError, expected_count, read_control_files
from landfall.sources.json_records import json_documents, parse_json_records
from landfall.sources.xml_rows import chunks_of_documents, parse_xml_fragments, row_fragments


def contract(names, **settings):
    return Contract(tuple(FieldRule(n) for n in names.split()), **settings)


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


class TestContract:
    def test_reads_rules(self):
        c = parse_contract("﻿" + json.dumps({
            "format": "csv", "delimiter": "|", "csv_header": False,
            "fields": {"id": {"required": True, "min_length": 2},
                       "phone": {"encrypt": True}, "skills": {}, "emergency_contact": {"encrypt_nested_phone": True}},
        }))
        assert (c.format, c.delimiter, c.has_header) == ("CSV", "|", False)
        assert [f.name for f in c.required] == ["id"]
        assert [(f.name, f.encrypt, f.warehouse_name) for f in c.encrypted] == [
            ("phone", "value", "phone_encrypted"), ("emergency_contact", "phone", "emergency_contact"),
        ]
        assert [f.shape for f in c.fields] == ["text", "text", "list", "object"]

    @pytest.mark.parametrize("text", [
        "", "[]", "{}", '{"fields": {}}', '{"fields": {"a": {}}, "format": "AVRO"}',
        '{"fields": {"a": {}}, "format": "fixedwidth"}',
    ])
    def test_unusable_is_fatal(self, text):
        with pytest.raises(ContractError):
            parse_contract(text)


class TestDelimited:
    def test_naming_overflow_and_missing(self, lines):
        df = parse_feed(lines("1,x", "1", "1,x,y,z", ",,"), contract("a b c", policy=Policy.lenient()))
        assert rows(df, "a", "b", "c", "_missing", "_overflow") == [
            ("1", "x", None, ["c"], None), ("1", None, None, ["b", "c"], None),
            ("1", "x", "y", None, ["z"]), ("", "", "", None, None),
        ]

    def test_header_blank_null_and_quotes(self, lines):
        given = lines("a,b", "a,b\r", "a,other", " \t", None, '"q, r')
        rest = [(" \t", None, "BLANK_ROW"), ('"q', " r", None)]
        assert rows(parse_feed(given, contract("a b")), "a", "b", "_error.type") == [("a", "other", None), *rest]
        lenient = replace(contract("a b"), policy=Policy.lenient())
        assert rows(parse_feed(given, lenient), "a", "b", "_error.type") == rest
        assert rows(parse_feed(lines("a", "1", "a2"), contract("a")), "a") == [("1",), ("a2",)]

    @pytest.mark.parametrize("delimiter", ["|", ".", "\t", "||", "\\", "'"])
    def test_delimiter_is_literal(self, lines, delimiter):
        df = parse_feed(lines(delimiter.join(["1", "", "3"])), contract("a b c", delimiter=delimiter))
        assert rows(df, "a", "b", "c") == [("1", "", "3")]

    def test_list_and_object_shapes(self, lines):
        c = Contract((FieldRule("s", shape="list"), FieldRule("o", shape="object")), has_header=False)
        df = parse_feed(lines('a; "b" ;;,x', ";;,", ",", "x", " ; ,y"), c)
        assert rows(df, "s", "o.raw") == [
            (["a", '"b"'], "x"), ([], ""), ([""], ""), (["x"], None), (["", ""], "y"),
        ]


class TestFixedWidth:
    C = replace(contract("a b z", format="FIXEDWIDTH"), columns=(FixedColumn("a", 1, 3), FixedColumn("b", 5, 3)))

    def test_clips_trims_and_drops_only_empty_lines(self, lines):
        df = parse_feed(lines("ab  cd ", "ab", "", "   ", "éßü x"), self.C)
        assert rows(df, "a", "b", "z", "_missing") == [
            ("ab", "cd", None, ["z"]), ("ab", "", None, ["z"]), ("", "", None, ["z"]), ("éßü", "x", None, ["z"]),
        ]

    def test_padding_stays_when_lenient(self, lines):
        df = parse_feed(lines("ab  cd "), self.C.with_policy(Policy.lenient()))
        assert rows(df, "a", "b") == [("ab ", "cd ")]


class TestJson:
    def test_lines(self, lines):
        df = parse_feed(
            lines('{"a": 1, "b": {"x": [1, "2"]}}', '{"a": null}', "", '{"a": 1', "[1]", "{'a': 1}", "5"),
            contract("a b", format="JSON"),
        )
        assert rows(df, "a", "b", "_missing", "_error.type") == [
            ("1", '{"x":[1,"2"]}', None, None), (None, None, ["b"], None),
            *[(None, None, None, "PARSE_ERROR")] * 4,
        ]

    def test_documents(self, lines):
        docs = ['[{"a": 1}, 7, {"a": [2]}]', '\n {"a":\n 3}\n', '{"a": 4}\n\n{"a": 5}\n', "[{]", "oops", " ", '{"a": ']
        records = json_documents(lines(*docs), keep_non_objects=False)
        df = parse_json_records(records, contract("a", format="JSON"))
        assert rows(df, "a", "_error.type") == [
            ("1", None), ("[2]", None), ("3", None), ("4", None), ("5", None),
            (None, "PARSE_ERROR"), (None, "PARSE_ERROR"), (None, "PARSE_ERROR"),
        ]
        kept = parse_json_records(json_documents(lines(docs[0])), contract("a", format="JSON"))
        assert rows(kept, "a", "_raw", "_error.type")[1] == (None, "7", "PARSE_ERROR")

    @pytest.mark.parametrize(("indent", "size"), [(None, "60"), (2, "60"), (2, "100000")])
    def test_arrays_are_cut_where_they_are_read(self, spark, tmp_path, indent, size):
        """Every element once, whatever its kind and wherever a split falls."""
        some = [{}, 7, {"a": 1, "b": {"c": "},\n{\"["}}, [1, {"a": [2]}], "x}\"]", None, {"a": "\\"}, [], {"a": [{}]}, "{"]
        files = {
            "many": [{"a": i, "b": "}" * (i % 5)} for i in range(60)], "some": some, "tail": [{"a": 1}, 7, "]"],
            "numbers": [7, 8], "none": [], "object": {"a": {"b": {}}},
        }
        c, session = contract("a", format="JSON", is_json_array=True), spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", size)
        session.conf.set("spark.sql.files.openCostInBytes", "1")
        for name, doc in files.items():
            (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=indent))
        (tmp_path / "blank.json").write_text("\n \n")
        (tmp_path / "lines.json").write_text('{"a": 1}\n\n{"a": {"b": 2}}\n')
        wanted = sorted(json.dumps(e) for d in files.values() for e in (d if isinstance(d, list) else [d]) if e is not None)
        wanted += ['{"a": 1}', '{"a": {"b": 2}}']
        found = feeds.json_arrays(session, str(tmp_path)).collect()
        assert all(r["_document"] is None for r in found)
        texts = [r.value for r in found if r.value is not None and r.value != "null"]
        plain = lambda t: t if t in ("x}\"]", "{", "]") else json.dumps(json.loads(t))
        strings = {json.dumps(t): t for t in ("x}\"]", "{", "]")}
        assert sorted(map(plain, texts)) == sorted(strings.get(w, w) for w in wanted)
        assert len(found) - len(texts) == 1  # the null
        lenient = rows(read_feed(session, str(tmp_path), replace(c, policy=Policy.lenient())), "_error.type")
        objects = sum(isinstance(e, dict) for d in files.values() for e in (d if isinstance(d, list) else [d]))
        assert len(lenient) == objects + 2 + 2  # the lines, null, and the text that begins as an object does

    @pytest.mark.parametrize("size", ["7", "100000"])
    def test_broken_arrays(self, spark, tmp_path, size):
        """A fault costs its piece; an array that is not closed has an error row at its end."""
        texts = {
            "cut": '[{"a": 1}, {"a": 2', "open": '[{"a": 1}, {"a": 2}', "comma": '[{"a": 1} {"a": 2}, {"a": 3}]',
            "word": "oops", "value": '[{"a": 1}, {"a": oops}, {"a": 3}]', "twice": '[{"a": 1},]',
        }
        for name, text in texts.items():
            (tmp_path / f"{name}.json").write_text(text)
        session = spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", size)
        session.conf.set("spark.sql.files.openCostInBytes", "1")
        df = read_feed(session, str(tmp_path), contract("a", format="JSON", is_json_array=True))
        got = df.selectExpr("regexp_extract(_source_file, '([a-z]+)[.]json', 1) AS f", "a", "_error IS NULL AS ok").collect()
        by = {n: (sorted(r.a for r in got if r.f == n and r.ok), sum(r.f == n and not r.ok for r in got)) for n in texts}
        assert by == {
            "cut": (["1"], 1), "open": (["1", "2"], 1), "comma": (["1", "3"], 1), "word": ([], 1), "value": (["1", "3"], 1),
            "twice": (["1"], 1),
        }


    @pytest.mark.parametrize("strict", [True, False])
    def test_chunks_hold_every_element(self, spark, tmp_path, strict):
        elements = [{}, 7, {"a": 1}, [1, {"b": 2}], "x", None, {"a": 2}, {"a": {"c": [3]}}]
        c = replace(contract("a", format="JSON", is_json_array=True), policy=Policy() if strict else Policy.lenient())
        (tmp_path / "x.json").write_text(json.dumps(elements, indent=2))
        (tmp_path / "y.json").write_text("[]")
        (tmp_path / "z.json").write_text(json.dumps([7, {"a": 9}], indent=2))
        whole = read_feed(spark, str(tmp_path), c)
        chunked = read_feed(spark, str(tmp_path), replace(c, record_end="\n  }"))
        shown = lambda df: sorted(map(str, rows(df, "a", "_error.type")))
        assert shown(chunked) == shown(whole) and chunked.count() == (10 if strict else 6)

    def test_chunk_that_is_no_array_is_an_error(self, spark, tmp_path):
        (tmp_path / "x.json").write_text('[\n  {"a": 1\n  },\n  {"a" 2\n  },\n  {"a": 3\n  }\n]')
        c = contract("a", format="JSON", is_json_array=True)
        got = read_feed(spark, str(tmp_path), replace(c, record_end="\n  }"))
        assert sorted(map(str, rows(got, "a", "_error.type"))) == ["('1', None)", "('3', None)", "(None, 'PARSE_ERROR')"]


@pytest.mark.parametrize("strict", [True, False])
def test_text_after_a_json_document(lines, strict):
    c = contract("a", format="JSON", policy=Policy() if strict else Policy.lenient())
    texts = ('{"a":1}', '{"a":1}{"a":2}', '{"a":1}, {"a":2}', '{"a":1} x', '{"a":1} \t', "[1]", "7", '[{"a":1}]')
    found = rows(parse_feed(lines(*texts), c), "a", "_error.reason")
    bad, good = (None, "malformed JSON"), ("1", None)
    after = bad if strict else good
    assert found == [good, after, after, after, good, bad, bad, bad]


def test_quoted_values(lines):
    c = contract("a b", has_header=True, quote='"')
    texts = ("a,b", '"a","b"', '"x,1","y ""z"""', 'x,"', '"open,1', ',""', '"q"t,2', '"1","2","3"', '" "')
    torn = "unbalanced quote"
    for policy, reason in ((Policy(), torn), (Policy.lenient(), None)):
        found = rows(parse_feed(lines(*texts), replace(c, policy=policy)), "a", "b", "_missing", "_error.reason")
        assert found == [
            ("x,1", 'y "z"', None, None), ("x", '"', None, reason), ('"open', "1", None, reason), ("", "", None, None),
            ('"q"t', "2", None, None), ("1", "2", None, "3 values for 2 fields" if reason else None), (" ", None, ["b"], None),
        ]
    long = '"' + "x,\"\"" * 20_000 + '"'
    assert rows(parse_feed(lines(long + ",1"), c), "a", "b") == [("x,\"" * 20_000, "1")]


def test_type_is_a_type():
    parse_contract(json.dumps({"fields": {"a": {"type": "decimal(10, 2)"}, "b": {"type": "array<int>"}}}))
    with pytest.raises(ContractError, match="not a type"):
        parse_contract(json.dumps({"fields": {"a": {"type": "int) IS NULL OR (1=1"}}}))


def test_two_control_files_are_refused(spark, tmp_path):
    for n in "ab":
        (tmp_path / f"{n}.properties").write_text("record_count=3\n")
    with pytest.raises(ControlFileError, match="more than one"):
        expected_count(spark, str(tmp_path))


class TestXml:
    C = contract("a b", format="XML", row_tag="r")

    def parse(self, lines, text, **kw):
        return parse_xml_fragments(row_fragments(chunks_of_documents(lines(text), "r"), "r", **kw), self.C)

    def test_cells(self, lines):
        text = (
            "\n<?xml version='1.0'?>\n<rs><r><a> 1 &lt;</a><b/></r> stray </r><r x='1'><a>no</a></r>"
            "<r><b>null</b></r><r><a>2<b></a></r><r><a><x>1</x></a><b>&#233;</b></r></rs>"
        )
        assert rows(self.parse(lines, text), "a", "b", "_missing", "_error.type") == [
            (" 1 <", "", None, None), (None, "null", ["a"], None), (None, None, None, "PARSE_ERROR"),
            ("<x>1</x>", "é", None, None),
        ]

    def test_declared_shapes(self, lines):
        c = Contract((FieldRule("n", shape="struct<x:string>"), FieldRule("m", shape="array<string>")), format="XML",
                     row_tag="r")
        frag = row_fragments(chunks_of_documents(lines("<r><n><x>1</x></n><m>a</m><m>b</m></r>"), "r"), "r")
        assert rows(parse_xml_fragments(frag, c), "n.x", "m") == [("1", ["a", "b"])]

    def test_unclosed_row(self, lines):
        text = "<rs><r><a>1</a></r><r><a>2</a>"
        assert rows(self.parse(lines, text), "a") == [("1",)]
        kept = rows(self.parse(lines, text, keep_unclosed=True), "a", "_error.type")
        assert kept == [("1", None), (None, "PARSE_ERROR")]

    @pytest.mark.parametrize("size", ["7", "100000"])
    def test_closing_text_in_cells_and_file_ends(self, spark, tmp_path, size):
        """Only an element that its file does not close is no row, wherever a split falls."""
        whole = "<rs><r><a>x/r>y</a></r><r><a>2</a></r>"
        ends = {"root": "</rs>", "bare": "", "open": "<r><a>3</a>", "torn": "<r><a>3</", "rooted": "<r><a>3</a></rs>"}
        for name, end in ends.items():
            (tmp_path / f"{name}.xml").write_text(whole + end)
        session = spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", size)
        session.conf.set("spark.sql.files.openCostInBytes", "1")
        good = sorted([("2", None), ("x/r>y", None)] * len(ends), key=str)
        strict = read_feed(session, str(tmp_path), self.C)
        assert sorted(rows(strict.filter("_error IS NULL"), "a", "_error.type"), key=str) == good
        assert strict.filter("_error IS NOT NULL").count() == 3
        lenient = read_feed(session, str(tmp_path), replace(self.C, policy=Policy.lenient()))
        assert sorted(rows(lenient, "a", "_error.type"), key=str) == good

    def test_one_file_is_read_by_many_tasks(self, spark, tmp_path):
        body = "".join(f"<r>\n <a>{i}</a><b>{'x' * (i % 97)}</b>\n</r>\n" for i in range(3000))
        (tmp_path / "big.xml").write_text(f"\n<?xml version='1.0'?>\n<rs>\n{body}</rs>\n")
        session = spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        session.conf.set("spark.sql.files.openCostInBytes", "1")
        df = read_feed(session, str(tmp_path / "big.xml"), self.C)
        assert df.rdd.getNumPartitions() > 20
        assert sorted(int(r.a) for r in df.select("a").collect()) == list(range(3000))
        assert df.filter("_error is not null").count() == 0


class TestControl:
    def test_counts(self, spark, tmp_path):
        texts = {
            "good": "# c\n\n owner = me = you\nrecord_count = 12 \n", "last": "record_count=1\nrecord_count=2",
            "none": "owner=x\n", "empty_value": "record_count=\n", "word": "record_count=ten", "commented": "#record_count=3",
        }
        for name, text in texts.items():
            (tmp_path / name).write_text(text)
        found = {r.control_file.rsplit("/", 1)[-1]: (r.expected_count, bool(r.problem))
                 for r in read_control_files(spark, str(tmp_path)).collect()}
        assert found == {
            "good": (12, False), "last": (2, False), "none": (None, True), "empty_value": (None, True),
            "word": (None, True), "commented": (None, True),
        }
        assert expected_count(spark, None) is None and expected_count(spark, "") is None
        assert expected_count(spark, str(tmp_path / "good")) == 12
        for bad in ("none", "word"):
            with pytest.raises(ControlFileError):
                expected_count(spark, str(tmp_path / bad))
        with pytest.raises(Exception):
            expected_count(spark, str(tmp_path / "gone"))


def test_unknown_format(lines):
    with pytest.raises(ContractError):
        parse_feed(lines("x"), contract("a", format="AVRO"))
