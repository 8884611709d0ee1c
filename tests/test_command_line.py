"""Jobs of the command line, in this process."""

import json

import pytest

from landfall import __main__ as command
from landfall.operators.splitting import part_manifest, split_files
from landfall.contract import Contract, FieldRule
from landfall.sources import read_feed


def test_intake_then_decrypt(spark, tmp_path, aes_key, monkeypatch, capsys):
    monkeypatch.setenv("LANDFALL_AES_KEY", aes_key)
    (tmp_path / "c.json").write_text(json.dumps({"csv_header": False, "fields": {"a": {"required": True}, "s": {"encrypt": True}}}))
    (tmp_path / "in.csv").write_text("1,first secret\n2,second\n")
    where = ["--contract", str(tmp_path / "c.json"), "--location", str(tmp_path / "t")]
    assert command.main(["intake", str(tmp_path / "in.csv"), *where, "--audit", str(tmp_path / "log"), "--execution-id", "r"]) == 0
    assert json.loads(capsys.readouterr().out)["actual_count"] == 2
    sealed = [r.s_encrypted for r in spark.read.parquet(str(tmp_path / "t/execution_id=r")).orderBy("a").collect()]
    assert command.main(["decrypt", *sealed]) == 0
    assert capsys.readouterr().out.splitlines() == ["first secret", "second"]
    assert command.main(["decrypt", *where, "--execution-id", "r", "--out", str(tmp_path / "clear")]) == 0
    assert sorted(r.s_encrypted for r in spark.read.json(str(tmp_path / "clear")).collect()) == ["first secret", "second"]
    with pytest.raises(SystemExit):
        command.main(["decrypt", "--location", "x"])


@pytest.mark.parametrize("fmt", ["CSV", "XML", "JSON"])
@pytest.mark.parametrize("rows", [1, 7, 100])
def test_parts_bounded_by_rows(spark, tmp_path, fmt, rows):
    c = Contract((FieldRule("a"),), format=fmt, row_tag="r")
    lines = {"CSV": "a\n" + "".join(f"{k}\n" for k in range(20)), "XML": "<rs>" + "".join(f"<r><a>{k}</a></r>" for k in range(20)) + "</rs>",
             "JSON": "".join(f'{{"a": "{k}"}}\n' for k in range(20))}
    (tmp_path / "in").write_text(lines[fmt])
    out = str(tmp_path / "out")
    sizes = [r.rows for r in split_files(spark, str(tmp_path / "in"), c, out, target_kb=64, max_rows=rows).collect() if r.rows]
    assert sum(sizes) == 20 and max(sizes) <= rows and len(sizes) == -(-20 // rows)
    assert sum(r.rows for r in part_manifest(spark, out, c).collect()) == 20
    assert sorted(int(r.a) for r in read_feed(spark, out, c).select("a").collect()) == list(range(20))
