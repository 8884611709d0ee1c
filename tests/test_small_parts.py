"""Splitting into many small parts, and reading many small files."""

import json

import pytest
from pyspark.sql import functions as F

from landfall.contract import Contract, FieldRule
from landfall.operators.splitting import split_files
from landfall.sources import read_feed
from landfall.sources.markup import xml_elements
from landfall.sources.quoted import quoted_records

NAMES = (FieldRule("a"), FieldRule("b"))
#: Short rows, then long ones, and one that is larger than a part.
ROWS = [(str(k), "x" * (10 if k < 800 else 700)) for k in range(1000)] + [("1000", "y" * 5000)]


def written(folder, fmt):
    if fmt == "XML":
        rows = "\n".join(f"<r><a>{a}</a><b>{b}</b></r>" for a, b in ROWS)
        (folder / "in.xml").write_text(f"<?xml version='1.0'?>\n<rs>\n{rows}\n</rs>\n")
        return str(folder / "in.xml"), Contract(NAMES, format="XML", row_tag="r")
    (folder / "in.json").write_text("[\n" + ",\n".join(json.dumps({"a": a, "b": b}) for a, b in ROWS) + "\n]\n")
    return str(folder / "in.json"), Contract(NAMES, format="JSON", is_json_array=True)


@pytest.mark.parametrize("max_rows", [None, 7])
@pytest.mark.parametrize("fmt", ["XML", "JSON"])
def test_no_part_is_larger_than_the_target(spark, tmp_path, fmt, max_rows):
    path, contract = written(tmp_path, fmt)
    out = str(tmp_path / "parts")
    manifest = [r for r in split_files(spark, path, contract, out, target_kb=2, max_rows=max_rows).collect() if r.rows]
    assert sum(r.rows for r in manifest) == len(ROWS)
    assert all(r.bytes <= 2048 or r.rows == 1 for r in manifest)
    assert max_rows is None or max(r.rows for r in manifest) <= max_rows
    again = Contract(NAMES, format="JSON") if fmt == "JSON" else contract
    assert sorted((r.a, r.b) for r in read_feed(spark, out, again).collect()) == sorted(ROWS)


def test_a_small_target_is_no_small_scan(spark, tmp_path):
    path, contract = written(tmp_path, "XML")
    session = spark.newSession()
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    split_files(session, path, contract, str(tmp_path / "parts"), target_kb=2)
    tasks = {p.name.split("-")[1] for p in (tmp_path / "parts").glob("part-*")}
    assert len(tasks) <= 2 and len(list((tmp_path / "parts").glob("part-*"))) > 60


def test_files_are_folded_in_batches(spark, tmp_path):
    path, _ = written(tmp_path, "XML")
    (tmp_path / "in.csv").write_text('1,"a\nb"\n')
    for found in (xml_elements(spark, path, "r"), quoted_records(spark, str(tmp_path / "in.csv"), ",", '"')):
        plan = found._jdf.queryExecution().toString()
        assert "InPandas" not in plan and "MapInArrow" in plan


def test_files_of_one_split_keep_their_torn_ends(spark, tmp_path):
    for k, text in enumerate(["<rs><r>1</r><r>2</r></rs>", "<rs><r>3</r><r>4", "<rs><r>5</r><!-- <r>6</r>", "</r><r>7</r>"]):
        (tmp_path / f"{k}.xml").write_text(text)
    found = xml_elements(spark, str(tmp_path), "r").select(F.regexp_extract("value", "[0-9]", 0).alias("n"), "closed").collect()
    assert sorted((r.n, r.closed) for r in found) == [("1", True), ("2", True), ("3", True), ("4", False), ("5", True), ("6", True), ("7", True)]
