"""Arrays that are damaged, packed, or both."""

import gzip
import json

import pyarrow as pa
import pytest

from landfall import Policy
from landfall.contract import Contract, FieldRule
from landfall.sources import json_arrays, read_feed

FEED = Contract((FieldRule("a"), FieldRule("b")), format="JSON", is_json_array=True)


def session_of(spark, size):
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    session.conf.set("spark.sql.files.openCostInBytes", "1")
    return session


def outcome(spark, path, policy=None):
    rows = read_feed(spark, str(path), FEED.with_policy(policy) if policy else FEED).select("a", "_error.type", "_raw").collect()
    return sorted(r.a for r in rows if r.type is None), [r._raw for r in rows if r.type is not None]


def put(folder, name, text, packed):
    (folder / (name + (".gz" if packed else ""))).write_bytes(gzip.compress(text.encode()) if packed else text.encode())
    return folder


ELEMENTS = [json.dumps({"a": str(k), "b": {"x": [{"y": k}], "s": 'q"}{'}}) for k in range(2000)]


@pytest.mark.parametrize("size", [3000, 10_000_000])
@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("damage", ["brace", "quote", "extra", "bracket"])
def test_damage_stays_small(spark, tmp_path, size, packed, damage):
    broken = list(ELEMENTS)
    if damage == "brace":
        broken[700] = broken[700][:-1]
    elif damage == "quote":
        broken[700] = broken[700].replace('"a": "700"', '"a": "700')
    elif damage == "extra":
        broken[700] += "}"
    else:
        broken[700] = broken[700].replace("}]", "}")
    put(tmp_path, "x.json", "[\n" + ",\n".join(broken) + "\n]\n", packed)
    good, bad = outcome(session_of(spark, size), tmp_path)
    assert len(good) >= 1998 and len(set(good)) == len(good)
    assert set(map(str, range(2000))) - set(good) <= {"700", "701"}
    assert 1 <= len(bad) <= 3 and all(len(b) < 300 for b in bad)


CASES = {
    "array": ('[{"a":"1"},{"a":"2"}]', ["1", "2"], 0),
    "spaced": (' [ {"a":"1"} , {"a":"2"} ] \n', ["1", "2"], 0),
    "objects": ('{"a":"1"}\n{"a":"2"}', ["1", "2"], 0),
    "object": ('{"a":"1"}', ["1"], 0),
    "not_closed": ('[{"a":"1"},{"a":"2"}', ["1", "2"], 1),
    "torn": ('[{"a":"1"},{"a":"2"', ["1"], 1),
    "torn_object": ('{"a":"1"', [], 1),
    "empty": ("[]", [], 0),
    "blank": (" \n", [], 0),
}


@pytest.mark.parametrize("size", [4, 100_000])
@pytest.mark.parametrize("packed", [False, True])
def test_packed_and_plain_are_equal(spark, tmp_path, size, packed):
    for name, (text, wanted, errors) in CASES.items():
        folder = tmp_path / name
        folder.mkdir()
        put(folder, "x.json", text, packed)
        good, bad = outcome(session_of(spark, size), folder)
        assert good == wanted, name
        assert (len(bad) >= 1) == bool(errors), (name, bad)
        if size > 1000:
            assert len(bad) <= errors + (name == "torn"), (name, bad)


def test_many_packed_elements(spark, tmp_path):
    put(tmp_path, "x.json", "[" + ",".join(ELEMENTS[:300]) + "]", True)
    for policy in (Policy(), Policy.lenient()):
        good, bad = outcome(spark, tmp_path, policy)
        assert len(good) == 300 and not bad


@pytest.mark.parametrize("packed", [False, True])
def test_lines_of_other_formats_packed(spark, tmp_path, packed):
    for name, text, contract in (
        ("c.csv", "1,x\n2,y", Contract((FieldRule("a"), FieldRule("b")), has_header=False)),
        ("l.json", '{"a":"1"}\n{"a":"2"}', Contract((FieldRule("a"),), format="JSON")),
    ):
        folder = tmp_path / name
        folder.mkdir()
        put(folder, name, text, packed)
        for policy in (Policy(), Policy.lenient()):
            rows = read_feed(spark, str(folder), contract.with_policy(policy)).select("a", "_error.type").collect()
            assert sorted(map(tuple, rows)) == [("1", None), ("2", None)]


def test_work_on_broken_elements_grows_with_the_text(monkeypatch):
    seen, init = [], json.JSONDecodeError.__init__

    def counted(self, msg, doc, pos):
        seen.append(min(len(doc), pos))  # the constructor counts the lines of the text before the error
        init(self, msg, doc, pos)

    monkeypatch.setattr(json.JSONDecodeError, "__init__", counted)
    elements = [json.dumps({"a": str(k), "b": "x" * 80}) for k in range(3000)]
    text = "[\n" + "\n,".join(e[:-1] if k % 3 == 0 else e for k, e in enumerate(elements)) + "\n]\n"
    chunks = text.split("}")
    state = {"_source_file": "f", "_block": 0, "_source_ts": None, "quoted": 0, "depth": 0, "root": 1, "first": True, "last": True,
             "open": True, "damaged": True, "first_key": '"a"'}
    run = pa.RecordBatch.from_pydict({n: [v] * len(chunks) for n, v in state.items()} | {"value": chunks})
    split = json_arrays._Split.of(run)
    found = [p["value"].strip() for p in [*split.add(run), *split.close()]]
    assert sum(seen) < 10 * len(text)
    assert [f.rstrip(",\n") for f in found] == [e[:-1] if k % 3 == 0 else e for k, e in enumerate(elements)]


@pytest.mark.parametrize("value", ['{"a": 1}', '["x", null]', "true", "-Infinity", "12.5e3", '"\\ud83d\\ude00"', '{"a": tru}', '{"a": "\\q"}', '{"a": [1, 2}', '"a', '{"a" 1}', "]"])
@pytest.mark.parametrize("before", [0, 4070, 4088, 4094, 16370])
def test_element_ends_as_the_whole_text_says(value, before):
    for text in (f'["{"x" * before}", {value}, 1]', f'[{" " * before}{value}', f'{{"k": "{"x" * before}", "v": {value}}} , 2'):
        for at in (0, 1, text.find(value)):
            try:
                end = json.JSONDecoder().raw_decode(text, at)[1]
            except ValueError:
                end = None
            assert json_arrays._element_end(text, at) == end
